"""Passages of held-out evaluation items inside a corpus.

Documents and items are compared as runs of words in one letter case; scripts without blanks count every character as
a word. For every item and diagonal band (document offset minus item offset, bands overlap by half), the shared
character q-grams are counted. A passage of m characters with at most e edits keeps at least m - q + 1 - q*e of its
q-grams inside one band, so regions below that bound for the item's shortest passage that counts are dropped without
looking at the text. What remains is verified by a banded word alignment, where a word may differ by a slip, words may
be missing or added, and foreign words cost. Items too short for the bound (less than `MIN_PASSAGE` characters in two
fifths of their words) count where they stand whole, word for word: anything less would be a short quotation.

Scale: items are made distinct by text, searched once, and their ids are joined to the finds afterwards. The corpus is
scanned once a block of items and never shuffled; a block holds at most `block_chars` characters whatever the size of
the item table, so no item is left out and what is broadcast (the texts of a block, indexed on the executors in linear
time) has a fixed bound. Every item is judged on its own: the answer does not depend on what shares its block. A bitmap
of the q-grams, at least eight entries each, drops most places of a document; counting and alignment are vectorised
over whole batches.

Defined cases: null and blank texts hold nothing; null or blank items leak nowhere; equal items under several ids leak
under every id; repeated rows count once; a document that occurs twice is reported under both ids; texts of any length
are searched whole; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

Q = 7
#: Least width of a diagonal band; items whose edit budget is larger have wider ones.
BAND = 96
#: Least characters of a passage that is compared with edits.
MIN_PASSAGE = 20
#: Share of the words in an accepted passage that must agree.
AGREE = 0.9
#: Scripts written without blanks: kana, Han, Thai, Lao, Myanmar, Khmer.
_UNSPACED = "぀-ヿ㐀-䶿一-鿿豈-﫿฀-໿က-႟ក-៿\U00020000-\U0003134f"
_TOKEN = re.compile(f"[{_UNSPACED}]|[^\\W_{_UNSPACED}]+")
#: A word divided at the end of a line.
_BROKEN = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n[ \t]*(?=[^\W\d_])")
_ASCII = {i: " " for i in range(128) if not chr(i).isalnum()}
#: Characters and (document, item) counters that are handled together.
_CHUNK, _CELLS = 400_000, 4_000_000


def tokens(text: str) -> list[str]:
    if "-" in text:
        text = _BROKEN.sub("", text)
    if text.isascii():
        return text.lower().translate(_ASCII).split()
    return _TOKEN.findall(unicodedata.normalize("NFKC", text).lower())


def _grams(s: str) -> np.ndarray:
    """Hash of every q-gram, by position."""
    c = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    c *= np.uint64(0x9E3779B97F4A7C15)
    c >>= np.uint64(44)
    n = len(c) - Q + 1
    h = c[:n].copy()
    for j in range(1, Q):
        h *= np.uint64(0x100000001B3)
        h += c[j : n + j]
    return h ^ (h >> np.uint64(29))


def _letters(w: str) -> int:
    """The letters of a word as bits: an edit changes at most two of them."""
    m = 0
    for c in w:
        m |= 1 << (ord(c) & 63)
    return m


def _slip(a: str, b: str) -> bool:
    """Whether two different words may be one word mistyped: numbers never, words within one edit in five characters."""
    if a[:2] != b[:2] and a[-2:] != b[-2:] or a.isdigit() or b.isdigit() or min(len(a), len(b)) < 4 or abs(len(a) - len(b)) > 2:
        return False
    budget = 1 if max(len(a), len(b)) < 7 else 2
    # what both ends share needs no edits
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[k:], b[k:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if max(len(a), len(b)) <= budget or budget == 1:
        return max(len(a), len(b)) <= budget
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0], least = row[0], i, i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
            least = min(least, row[j])
        if least > budget:
            return False
    return row[-1] <= budget


def align(same: list[np.ndarray]) -> list[tuple[int, int]]:
    """(words matched, item words spanned) of the best local alignment of each candidate, all candidates at once.

    same: for each candidate (item words, diagonals), whether the item's word i is the document's word i + diagonal.
    A match gives 1, a foreign word takes 2, a missing or added word 0.9. A state is one integer: tenths of the score,
    then the words matched, then the first item word.
    """
    one, hit, start = 1 << 40, (10 << 40) + (1 << 20), (1 << 20) - 1
    out: list = [None] * len(same)
    order = sorted(range(len(same)), key=lambda k: same[k].shape)
    for at in range(0, len(order), 128):
        ids = order[at : at + 128]
        rows, width = max(same[k].shape[0] for k in ids), max(same[k].shape[1] for k in ids)
        m = np.zeros((rows, len(ids), width), bool)
        for r, k in enumerate(ids):
            m[: same[k].shape[0], r, : same[k].shape[1]] = same[k]
        inside = np.arange(width) < np.array([same[k].shape[1] for k in ids])[:, None]
        ramp = np.arange(width, dtype=np.int64) * (9 * one)
        prev = np.zeros((len(ids), width + 1), np.int64)
        best, end = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for i in range(rows):
            cell = np.where(prev[:, :width] >= one, prev[:, :width], i)
            cell += np.where(m[i], hit, -20 * one)
            np.maximum(cell, prev[:, 1:] - 9 * one, out=cell)
            cell += ramp
            np.maximum.accumulate(cell, axis=1, out=cell)
            cell -= ramp
            prev[:, :width] = np.where(inside & (cell >= one), cell, 0)
            top = prev.max(1)
            better = top > best
            best[better], end[better] = top[better], i
        for r, k in enumerate(ids):
            b = int(best[r])
            out[k] = (b >> 20 & start, int(end[r]) + 1 - (b & start)) if b else (0, 0)
    return out


class Index:
    """One block of items: the q-grams of those that are compared with edits, and the others whole."""

    def __init__(self, items: list[tuple[int, str]], share: float, error: float):
        words = [(k, w) for k, t in items if (w := tokens(t))]
        self.ids, self.words, self.need, least = [], [], [], []
        self.whole: dict[str, list[int]] = {}
        for k, w in words:
            need = max(1, int(np.ceil(share * len(w) - 1e-9)))
            ends = np.cumsum([0] + [len(x) + 1 for x in w])
            m = int((ends[need:] - ends[:-need]).min()) - 1  # characters of the shortest passage that counts
            if m < MIN_PASSAGE:
                self.whole.setdefault(" ".join(w), []).append(k)
                continue
            self.ids.append(k)
            self.words.append(w)
            self.need.append(need)
            least.append(m)
        m = np.array(least, float)
        #: The least number of shared q-grams in a band, and half the width of the bands, by item.
        self.bound = np.maximum(np.ceil(m - Q + 1 - Q * error * m), 1)
        self.half = np.maximum(BAND // 2, np.ceil(error * m).astype(np.int64) + 1) if len(m) else np.zeros(0, np.int64)
        self.begins = [np.cumsum([0] + [len(x) + 1 for x in w])[: len(w)] for w in self.words]
        self.chars = np.array([int(b[-1]) + len(w[-1]) for b, w in zip(self.begins, self.words)], np.int64)
        grams = [_grams(" ".join(w)) for w in self.words]
        n = [len(g) for g in grams]
        code = np.concatenate([*grams, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(n)), n)
        pos = np.concatenate([*(np.arange(k) for k in n), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(code, kind="stable")
        code, self.item, self.pos = code[order], item[order], pos[order]
        self.code, self.first = np.unique(code, return_index=True)
        self.count = np.diff(np.append(self.first, len(code)))
        self.mask = np.uint64((1 << max(16, int(8 * len(self.code)).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[(self.code & self.mask).astype(np.int64)] = True
        vocab: dict[str, int] = {}
        self.word_ids = [np.array([vocab.setdefault(x, len(vocab)) for x in w]) for w in self.words]
        self.vocab = vocab
        self.places: list[dict[int, list[int]]] = []
        for w in self.word_ids:
            self.places.append({})
            for r, v in enumerate(w.tolist()):
                self.places[-1].setdefault(v, []).append(r)
        self.read: dict[str, tuple[int, tuple[int, ...]]] = {}
        self.heads: dict[tuple[str, int], list[tuple[str, int]]] = {}
        for w in vocab:
            if len(w) >= 4 and not w.isdigit():
                for edge in {w[:2], "$" + w[-2:]}:
                    self.heads.setdefault((edge, len(w)), []).append((w, _letters(w)))
        self.finder = None
        if self.whole:
            import ahocorasick

            self.finder = ahocorasick.Automaton()
            for s in self.whole:
                self.finder.add_word(f" {s} ", s)
            self.finder.make_automaton()

    def _read(self, w: str) -> tuple[int, tuple[int, ...]]:
        """A word's number among the words of the items, or -1, and the numbers of those that it may be a slip of."""
        near: set[str] = set()
        if len(w) >= 4 and not w.isdigit():
            mine = _letters(w)
            for n in range(len(w) - 2, len(w) + 3):
                most = 2 if max(len(w), n) < 7 else 4
                for e in (w[:2], "$" + w[-2:]):
                    near.update(x for x, m in self.heads.get((e, n), ()) if (m ^ mine).bit_count() <= most)
            near.discard(w)
        if len(self.read) > 500_000:
            self.read.clear()
        self.read[w] = r = self.vocab.get(w, -1), tuple(self.vocab[x] for x in near if _slip(w, x))
        return r

    def _codes(self, doc: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
        """The places of a document's words in its line, their numbers, and (place, number) of what may be slips."""
        get = self.read.get
        got = [get(w) or self._read(w) for w in doc]
        slips = [(j, v) for j, (_, s) in enumerate(got) if s for v in s]
        return np.cumsum([0] + [len(w) + 1 for w in doc]), np.fromiter((c for c, _ in got), np.int64, len(got)), slips

    def _regions(self, lines: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(line, item, lowest, highest diagonal) of every band that keeps the bound."""
        text = ("\0" * Q).join(lines)
        g = _grams(text)
        at = np.flatnonzero(self.bits[(g & self.mask).astype(np.int64)])
        k = np.searchsorted(self.code, g[at])
        k[k == len(self.code)] = 0
        ok = self.code[k] == g[at]
        at, k = at[ok], k[ok]
        starts = np.cumsum([0] + [len(x) + Q for x in lines])[: len(lines)]
        line = np.searchsorted(starts, at, "right") - 1
        n = self.count[k]
        total = int(n.sum())
        if not total:
            return
        place = np.repeat(np.arange(len(at)), n)
        entry = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
        item = self.item[entry]
        pair = line[place] * len(self.ids) + item
        # a whole item must reach the bound before its bands can
        kept = (np.bincount(pair, minlength=len(lines) * len(self.ids)) >= np.tile(self.bound, len(lines)))[pair]
        place, entry, item, pair = place[kept], entry[kept], item[kept], pair[kept]
        if not len(pair):
            return
        where = at[place] - starts[line[place]]
        diag = where - self.pos[entry]
        half = self.half[item]
        for shift in (0, 1):
            band = (diag + shift * half) // (2 * half)
            low = int(band.min())
            span = int(band.max()) - low + 1
            key = pair * span + (band - low)
            # a q-gram that repeats inside an item counts once at each place of the document
            order = np.lexsort((where, key))
            key_o, where_o = key[order], where[order]
            fresh = np.ones(len(key_o), bool)
            fresh[1:] = (key_o[1:] != key_o[:-1]) | (where_o[1:] != where_o[:-1])
            which, count = np.unique(key_o[fresh], return_counts=True)
            item_of = which // span % len(self.ids)
            good = count >= self.bound[item_of]
            for w, i in zip(which[good].tolist(), item_of[good].tolist()):
                h = int(self.half[i])
                d0 = (w % span + low) * 2 * h - shift * h
                yield w // span // len(self.ids), i, d0 - BAND // 2, d0 + 2 * h + BAND // 2

    def _same(self, doc: tuple[np.ndarray, np.ndarray, list[tuple[int, int]]], i: int, d0: int, d1: int) -> np.ndarray | None:
        """The agreement of the item's words with the region's, or None where no passage of it can agree well enough."""
        starts, codes, slips = doc
        ids, begins = self.word_ids[i], self.begins[i]
        n = np.arange(len(ids))
        # where the item's words would begin, for each of its words, at both edges of the band
        low = int((np.searchsorted(starts, begins + d0) - n).min()) - 2
        high = int((np.searchsorted(starts, begins + d1) - n).max()) + 2
        width = high - low + 1
        size = len(ids) + width
        part = np.full(size, -1)
        a, b = max(0, low), min(len(codes), low + size)
        if b > a:
            part[a - low : b - low] = codes[a:b]
        same = np.lib.stride_tricks.sliding_window_view(part, width)[: len(ids)] == ids[:, None]
        of = self.places[i]
        for j, v in slips[bisect_left(slips, (a,)) : bisect_left(slips, (b,))]:
            for r in of.get(v, ()):
                if 0 <= j - low - r < width:
                    same[r, j - low - r] = True
        # an accepted passage has a stretch of `need` words of which all but 2 (1 - AGREE) agree with something
        need = self.need[i]
        seen = np.cumsum(np.concatenate([[0], same.any(1)]))
        return same if (seen[need:] - seen[:-need]).max() >= (2 * AGREE - 1) * need - 1e-9 else None

    def _chunk(self, docs: list[list[str]]) -> list[dict[int, float]]:
        out: list[dict[int, float]] = [{} for _ in docs]
        lines = [" ".join(d) for d in docs]
        if self.finder is not None:
            for k, line in enumerate(lines):
                for _, s in self.finder.iter(f" {line} "):
                    out[k].update(dict.fromkeys(self.whole[s], 1.0))
        if self.ids and lines:
            met, same, read = [], [], {}
            for k, i, d0, d1 in self._regions(lines):
                if k not in read:
                    read[k] = self._codes(docs[k])
                m = self._same(read[k], i, d0, d1)
                if m is not None:
                    met.append((k, i))
                    same.append(m)
            for (k, i), (matched, spanned) in zip(met, align(same)):
                # sentences of like wording about other names and numbers share about three words in four
                if matched >= self.need[i] and matched >= AGREE * spanned:
                    out[k][self.ids[i]] = max(out[k].get(self.ids[i], 0.0), matched / len(self.words[i]))
        return out

    def search(self, texts: list[str]) -> list[dict[int, float]]:
        """For each text, item -> share of its words in the best passage, of every item that leaked into it."""
        out: list[dict[int, float]] = []
        block: list[list[str]] = []
        size, most = 0, max(1, _CELLS // max(1, len(self.ids)))
        for t in texts:
            if block and (size + len(t) > _CHUNK or len(block) >= most):
                out += self._chunk(block)
                block, size = [], 0
            block.append(tokens(t))
            size += len(t)
        return out + self._chunk(block) if block else out


def item_blocks(texts: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """(key, text) of distinct items, a block of at most `block_chars` characters (or one item) at a time."""
    block: list[tuple[int, str]] = []
    size = 0
    for r in texts.toLocalIterator():
        if block and size + len(r["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((r["key"], r["text"]))
        size += len(r["text"])
    if block:
        yield block


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", share: float = 0.4, error: float = 0.085, block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, matched_share) of every document that holds at least `share` of an item's words as one passage.

    error: edits a character that the q-gram bound allows for.
    """
    spark = docs.sparkSession
    kinds = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_id]
    named = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).filter("item_id IS NOT NULL AND length(trim(text)) > 0").distinct()
    texts = cut(named.select("text").distinct().withColumn("key", F.monotonically_increasing_id()))
    src = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter("length(trim(t)) > 0")
    schema = f"doc_id {kinds[0]}, key bigint, matched_share double"
    out = None
    for block in item_blocks(texts, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = Index(shared.value, share, error)
            for b in batches:
                rows = [(i, k, r) for i, found in zip(b["i"].tolist(), index.search(b["t"].tolist())) for k, r in found.items()]
                yield pd.DataFrame(rows, columns=["doc_id", "key", "matched_share"])

        part = src.mapInPandas(scan, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"doc_id {kinds[0]}, item_id {kinds[1]}, matched_share double")
    ids = named.join(texts, "text").select("key", "item_id")
    return out.join(ids, "key").groupBy("doc_id", "item_id").agg(F.max("matched_share").alias("matched_share"))


def leaked_items(found: DataFrame) -> DataFrame:
    """(item_id, documents): in how many documents each item leaked."""
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"))
