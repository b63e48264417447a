"""Extracted records against a hand-checked set: candidate pairs, greedy one-to-one matching, scorecard."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.columns import match_key, normalize_key
from ..functions.fuzzy import token_sort_ratio, word_sets
from ..session import cut, small_enough

#: Records of either side of a group that are held against each other in one go, about; larger groups are cut into such blocks.
BLOCK = 1000


#: Pairs of records that a task gives out in one go.
PAIRS = 1 << 19
#: Longer keys are scored without a look at their ceiling, which would cost as much.
LONG = 256
_ONES = np.array([(1 << n) - 1 for n in range(65)], dtype=np.uint64)


class _Side:
    """Words, lengths and counts of characters of a block's keys."""

    def __init__(self, keys: list[str]):
        self.words = list(map(set, map(str.split, keys)))
        self.lists = list(map(sorted, self.words))
        self.text = list(map(" ".join, self.lists))
        self.size = np.array(list(map(len, self.text)), dtype=np.int64)
        self.code = np.frombuffer("".join(self.text).encode("utf-32-le"), dtype="<u4").astype(np.int64) & 127
        self.row = np.repeat(np.arange(len(keys)), self.size)
        self.at = np.arange(len(self.code)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.count = np.bincount(self.row * 128 + self.code, minlength=len(keys) * 128).reshape(-1, 128)

    def number(self, numbers: defaultdict[str, int], none: int) -> None:
        """The words in one list (word, its length with a blank, row). Of keys that are not long, by place of the word: its number (`none` beyond the last), its length with a blank and where it lies, in bits from below (bits) and from above (heads), 64 characters a part."""
        many, rows = np.array(list(map(len, self.lists)), dtype=np.int64), len(self.lists)
        flat = list(chain.from_iterable(self.lists))
        self.word = np.array(list(map(numbers.__getitem__, flat)), dtype=np.int32)
        self.blank = np.array(list(map(len, flat)), dtype=np.int64) + 1
        self.of = np.repeat(np.arange(rows), many)
        short = (self.size <= LONG)[self.of]
        row, place = self.of[short], (np.arange(len(flat)) - np.repeat(np.cumsum(many) - many, many))[short]
        most = int(place.max(initial=-1)) + 1
        self.ids = np.full((most, rows), none, dtype=np.int32)
        self.ids[place, row] = self.word[short]
        self.length = np.zeros((most, rows), dtype=np.int64)
        self.length[place, row] = self.blank[short]
        start = np.cumsum(self.length, axis=0) - self.length
        self.bits, self.heads = [], []
        for k in range(-(-int(self.size[self.size <= LONG].max(initial=1)) // 64)):
            lo, hi = np.clip(start - 64 * k, 0, 64), np.clip(start + self.length - 64 * k, 0, 64)
            self.bits.append(_ONES[hi] ^ _ONES[lo])
            self.heads.append(_ONES[64 - lo] ^ _ONES[64 - hi])

    def spell(self, codes: np.ndarray) -> None:
        """Of keys that are not long: the characters at each place, and for each character where it stands, in bits."""
        to = np.full(128, len(codes))  # what the other side has not, and the end
        to[codes] = np.arange(len(codes))
        self.wide, rows = len(codes) + 1, len(self.text)
        short = (self.size <= LONG)[self.row]
        row, at, code = self.row[short], self.at[short], to[self.code[short]]
        self.chars = np.full((int(at.max(initial=0)) + 1, rows), len(codes), dtype=np.int64)
        self.chars[at, row] = code
        fit = code < len(codes)
        self.masks = np.zeros((len(self.bits), rows * self.wide), dtype=np.uint64)
        np.bitwise_or.at(self.masks, (at[fit] // 64, row[fit] * self.wide + code[fit]), np.uint64(1) << (at[fit] % 64).astype(np.uint64))


def _shared_words(a: _Side, b: _Side, lo: int, hi: int, to: int, end: int) -> np.ndarray:
    """Length of the common words of each pair of rows lo:hi and to:end, a blank after each."""
    i, j = (slice(*np.searchsorted(x.of, (p, q))) for x, p, q in ((a, lo, hi), (b, to, end)))
    word, row, n = a.word[i], a.of[i] - lo, a.blank[i]
    order = np.argsort(b.word[j], kind="stable")
    there, at = b.word[j][order], (b.of[j] - to)[order]
    first = np.searchsorted(there, word)
    times = np.searchsorted(there, word, side="right") - first
    often = times * np.bincount(word, minlength=1)[word] > 64
    # words of few pairs one by one, those of many in a product of matrices
    few = np.flatnonzero(~often)
    last = np.cumsum(times[few])
    k = np.repeat(few, times[few])
    pair = row[k] * (end - to) + at[np.arange(len(k)) - np.repeat(last - times[few], times[few]) + first[k]]
    out = np.bincount(pair, n[k], (hi - lo) * (end - to)).astype(np.float32).reshape(hi - lo, end - to)
    if often.any():
        names = np.unique(word[often])
        x, y = np.zeros((hi - lo, len(names)), dtype=np.float32), np.zeros((len(names), end - to), dtype=np.float32)
        x[row[often], np.searchsorted(names, word[often])] = n[often]
        k = np.isin(there, names)
        y[np.searchsorted(names, there[k]), at[k]] = 1
        out += x @ y
    return out


def _shared_characters(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Characters that each pair has in common, in whatever order; a row of x and y counts the characters of one key."""
    out = np.zeros((len(x), len(y)), dtype=x.dtype)
    for lo in range(0, len(x), 128):
        part = out[lo : lo + 128]
        for k in np.flatnonzero(x.any(0) & y.any(0)):
            part += np.minimum(x[lo : lo + 128, k, None], y[None, :, k])
    return out


def _common(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Of the pairs (i, j): length of the common words, a blank after each, and for each place of a word on either side whether it is common."""
    right = [x.take(j) for x in b.ids]
    left, back, words = [], [np.zeros(len(j), dtype=bool) for _ in right], np.zeros(len(i), dtype=np.int64)
    for x, n in zip(a.ids, a.length):
        x, here = x.take(i), np.zeros(len(i), dtype=bool)
        for y, there in zip(right, back):
            hit = x == y
            here |= hit
            there |= hit
        left.append(here)
        words += n.take(i) * here
    return words, left, back


def _rest(bits: np.ndarray, rows: np.ndarray, common: list[np.ndarray]) -> np.ndarray:
    """Where the words that are not common lie."""
    out = np.zeros(len(rows), dtype=np.uint64)
    for x, c in zip(bits, common):
        out |= x.take(rows) * ~c
    return out


def _subsequences(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of the pairs (i, j): length of the common words, a blank after each, and of the longest common subsequence of the others, bit-parallel over all pairs at once. Exact, or one more for a blank at the end."""
    words, left, back = _common(a, b, i, j)
    parts, steps = max(1, -(-int(a.size[i].max()) // 64)), int(b.size[j].max())
    live = [_rest(a.bits[k], i, left) for k in range(parts)]
    base, s = i * a.wide, [np.full(len(i), ~np.uint64(0)) for _ in range(parts)]
    at, m, u, t, on = (np.empty(len(i), dtype=x) for x in (np.int64, np.uint64, np.uint64, np.uint64, np.int64))
    for c in range(steps):
        if c % 64 == 0:
            ahead = _rest(b.heads[c // 64], j, back).view(np.int64)
        np.right_shift(ahead, 63, out=on)  # all bits or none
        np.left_shift(ahead, 1, out=ahead)
        np.take(b.chars[c], j, out=at, mode="clip")
        np.add(at, base, out=at)
        carry = None
        for k in range(parts):
            np.take(a.masks[k], at, out=m, mode="clip")
            np.bitwise_and(m, live[k], out=m)
            np.bitwise_and(m, on.view(np.uint64), out=m)
            np.bitwise_and(s[k], m, out=u)
            np.add(s[k], u, out=t)
            np.subtract(s[k], u, out=m)
            if parts > 1:
                over = t < u
                if carry is not None:
                    t += carry
                    over |= t < carry
                carry = over.astype(np.uint64)
            np.bitwise_or(t, m, out=s[k])
    return words + sum(np.bitwise_count(~x).astype(np.int64) for x in s)


def _ceilings(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """`_subsequences` of the pairs, of which neither key is long: pairs of like lengths together, one side's characters in a word of 64 bits where that is possible."""
    out = np.zeros(len(i), dtype=np.int64)
    m, n = a.size[i], b.size[j]
    kept = np.where(np.maximum(m, n) <= 64, m >= n, m <= n)
    for x, y, p, q, here in ((a, b, i, j, kept), (b, a, j, i, ~kept)):
        pick = np.flatnonzero(here)
        pick = pick[np.argsort((-(-x.size[p[pick]] // 64) * (LONG + 1) + y.size[q[pick]]).astype(np.int16), kind="stable")]
        for lo in range(0, len(pick), 16384):
            at = pick[lo : lo + 16384]
            out[at] = _subsequences(x, y, p[at], q[at])
    return out


def _few(a: _Side, b: _Side, x: np.ndarray, y: np.ndarray, ends: list[tuple[int, int, int, int]], half: float, part: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """`_many` of small groups (lo, hi, to, end), the pairs of all groups in one list."""
    lo, hi, to, end = np.array(ends, dtype=np.int64).T
    n = (hi - lo) * (end - to)
    last = np.cumsum(n)
    for first in range(0, int(last[-1]), 65_536):
        at = np.arange(first, min(first + 65_536, int(last[-1])))
        g = np.searchsorted(last, at, side="right")
        i, j = np.divmod(at - (last - n)[g], (end - to)[g])
        i, j = i + lo[g], j + to[g]
        words = _common(a, b, i, j)[0]
        both = np.minimum(x[i], y[j]).sum(-1, dtype=np.int64)
        sure = words - 1 >= part * np.minimum(a.size[i], b.size[j]) - 1e-6
        keep = sure | (both >= half * (a.size[i] + b.size[j]) - 1e-6)
        yield i[keep], j[keep], sure[keep]


def _many(a: _Side, b: _Side, x: np.ndarray, y: np.ndarray, group: tuple[int, int, int, int], half: float, part: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, sure) of the pairs of a group that the length of the common words (then they are sure) or the characters in common do not rule out."""
    lo, hi, to, end = group
    words = _shared_words(a, b, lo, hi, to, end)
    m, n = a.size[lo:hi, None], b.size[None, to:end]
    kind = np.float32 if x.dtype == np.uint8 else np.float64  # a bound may be too low, not too high
    m1, n1, m2, n2 = ((z - 1e-3).astype(kind) for z in (part * m, part * n, half * m, half * n))
    words -= 1
    sure = (words >= m1) | (words >= n1)
    i, j = np.nonzero(sure | (_shared_characters(x[lo:hi], y[to:end]) - m2 >= n2))
    return i + lo, j + to, sure[i, j]


def block_scores(left: list[str], right: list[str], ends: list[tuple[int, int]], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the pairs of keys whose token-set score is at least `least`. `ends` says where each group ends on either side; pairs are those of one group.

    All pairs are looked at, but most are ruled out by bounds that no score exceeds. A score is that of the common words
    against one side, known from their length, or that of both sides' words. The latter is bounded by the characters in
    common, then by the common words together with the common subsequence of the remaining ones. What is left is scored.
    """
    a, b, most = _Side(left), _Side(right), least - 1e-9
    half, part = most / 200, most / (200 - most)
    used = np.flatnonzero(a.count.any(0) & b.count.any(0))
    kind = np.uint8 if max(a.size.max(), b.size.max()) < 256 else np.int32
    x, y = a.count[:, used].astype(kind), b.count[:, used].astype(kind)
    numbers: defaultdict[str, int] = defaultdict(count().__next__)
    a.number(numbers, -1)
    b.number(numbers, -2)
    found, few, lo, to = [], [], 0, 0
    for hi, end in ends:
        if (hi - lo) * (end - to) > 16_384 or max(a.size[lo:hi].max(initial=0), b.size[to:end].max(initial=0)) > LONG:
            found.append(_many(a, b, x, y, (lo, hi, to, end), half, part))
        elif hi > lo and end > to:
            few.append((lo, hi, to, end))
        lo, to = hi, end
    if few:
        found += _few(a, b, x, y, few, half, part)
    i, j, sure = map(np.concatenate, zip(*found)) if found else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool))
    sure |= (a.size[i] > LONG) | (b.size[j] > LONG)
    p, q = i[~sure], j[~sure]
    i, j = i[sure], j[sure]
    if len(p):
        a.spell(used)
        b.spell(used)
        near = _ceilings(a, b, p, q) >= half * (a.size[p] + b.size[q]) - 1e-6
        i, j = np.concatenate([i, p[near]]), np.concatenate([j, q[near]])
    score = np.array([word_sets(a.words[m], b.words[n]) for m, n in zip(i.tolist(), j.tolist())], dtype=np.float64)
    keep = score >= least
    return i[keep], j[keep], score[keep]


def _distinct(keys: list[str], ends: list[int]) -> tuple[list[str], list[int], np.ndarray, np.ndarray]:
    """Each key once in its group: the keys, where the groups end, and the places of all keys in the order of these, with where those of each end."""
    once, stops, of, lo = [], [], [], 0
    for hi in ends:
        seen: dict[str, int] = {}
        n = len(once)
        of += [n + seen.setdefault(k, len(seen)) for k in keys[lo:hi]]
        once += seen
        stops.append(len(once))
        lo = hi
    at = np.array(of, dtype=np.int64)
    return once, stops, np.argsort(at, kind="stable"), np.cumsum(np.bincount(at, minlength=len(once)))


def _repeated(i: np.ndarray, j: np.ndarray, score: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs of distinct keys for all places where the keys stand, so many at once; a and b have what `_distinct` says of the places."""
    m, n = (np.diff(stops, prepend=0)[k] for (_, stops), k in ((a, i), (b, j)))
    last = np.cumsum(m * n)
    for lo in range(0, int(last[-1]) if len(i) else 0, PAIRS):
        at = np.arange(lo, min(lo + (PAIRS), int(last[-1])))
        g = np.searchsorted(last, at, side="right")
        p, q = np.divmod(at - (last - m * n)[g], n[g])
        yield a[0][(a[1][i] - m)[g] + p], b[0][(b[1][j] - n)[g] + q], score[g]


def _blocks(df: DataFrame, keys: list[str], number: str, text: str) -> DataFrame:
    """(keys, _k, numbers, texts): the records of each group that have a text in lists of about BLOCK, the same texts in one list."""
    n = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_n"))
    k = F.pmod(F.xxhash64(text), F.col("_n")).alias(f"{text}k")
    # the texts are left out here, not by a filter, which would compute them again, as would the count above
    g = df.join(n, keys).select(*keys, k, number, text).groupBy(*keys, f"{text}k").agg(F.collect_list(F.when(F.col(text) != "", F.struct(number, text))).alias("_r"))
    return g.filter(F.size("_r") > 0).select(*keys, f"{text}k", F.col(f"_r.{number}").alias(number), F.col(f"_r.{text}").alias(text))


def candidates(gold: DataFrame, found: DataFrame, keys: list[str], match_key: str = "key", least: float = 75.0) -> DataFrame:
    """(keys, gi, ei, score) of pairs that score at least `least`; gold has gi, found has ei, both the match key.

    Pairs meet inside one group of keys; groups with empty keys on either side are dropped. Large groups are cut into
    blocks, and each two blocks of a group are one row that any task may take.
    """
    a = gold.select(*keys, "gi", F.col(match_key).alias("_a"))
    b = found.select(*keys, "ei", F.col(match_key).alias("_b"))
    pairs = _blocks(a, keys, "gi", "_a").join(_blocks(b, keys, "ei", "_b"), keys)
    # a number of partitions is kept, where otherwise few bytes with much work would be put together
    tasks = int(gold.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(tasks, *keys, "_ak", "_bk").select(*keys, "gi", "_a", "ei", "_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            gi, ei = t["gi"].flatten(), t["ei"].flatten()
            left, right = t["_a"].flatten().to_pylist(), t["_b"].flatten().to_pylist()
            m, n = (np.concatenate([[0], np.cumsum(t[c].value_lengths().to_numpy())]).astype(np.int64) for c in ("_a", "_b"))
            lo = 0
            while lo < t.num_rows:  # so many groups at once as make up a few blocks
                hi = max(lo + 1, int(np.searchsorted(np.maximum(m - m[lo], n - n[lo]), 4 * BLOCK, side="right")) - 1)
                one, stops, *x = _distinct(left[m[lo] : m[hi]], (m[lo + 1 : hi + 1] - m[lo]).tolist())
                two, halts, *y = _distinct(right[n[lo] : n[hi]], (n[lo + 1 : hi + 1] - n[lo]).tolist())
                for i, j, score in _repeated(*block_scores(one, two, list(zip(stops, halts)), least), x, y):
                    i, j = i + m[lo], j + n[lo]
                    row = pa.array(np.searchsorted(m, i, side="right") - 1)
                    yield pa.RecordBatch.from_arrays([*[t[k].take(row) for k in keys], gi.take(pa.array(i)), ei.take(pa.array(j)), pa.array(score)], names=[*keys, "gi", "ei", "score"])
                lo = hi

    out = StructType([*[a.schema[k] for k in keys], a.schema["gi"], b.schema["ei"], StructField("score", DoubleType())])
    return pairs.mapInArrow(run, out)


def greedy(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """One-to-one matches, best score first; equal scores prefer the larger gi, then the larger ei."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, g, e = None, set(), set()
        for t in batches:
            rows = []
            for k, (*now, gi, ei) in enumerate(zip(*[t[c].to_pylist() for c in (*keys, "gi", "ei")])):
                if now != group:
                    group, g, e = now, set(), set()
                if gi not in g and ei not in e:
                    g.add(gi)
                    e.add(ei)
                    rows.append(k)
            yield t.take(pa.array(rows, type=pa.int64()))

    # a number of partitions is kept here too; a group's rows come sorted, and only the numbers taken are held
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = [F.col(c).desc() for c in ("score", "gi", "ei")]
    return pairs.repartition(tasks, *keys).sortWithinPartitions(*keys, *best).mapInArrow(pick, pairs.schema)


def field_correct(gold: Column, found: Column, text: bool, least: float = 85.0) -> Column:
    """Equality; for texts a token-sort score of the normalised values; two nulls agree."""
    if not text:
        return gold.eqNullSafe(found)
    both = gold.isNotNull() & found.isNotNull()
    fuzzy = token_sort_ratio(normalize_key(gold), normalize_key(found)) >= least
    return F.when(both, fuzzy).otherwise(gold.isNull() & found.isNull())


def tallies_exact(gold: list[Column], found: list[Column]) -> Column:
    ok = F.lit(True)
    for a, b in zip(gold, found):
        ok = ok & (F.coalesce(a, F.lit(0)) == F.coalesce(b, F.lit(0)))
    return ok


def scorecard(gold: DataFrame, found: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """Golden, extracted and matched records with precision and recall; an empty denominator gives 1."""
    n = lambda df, c: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(c))
    return _rates(n(gold, "golden").join(n(found, "extracted"), keys, "full").join(n(matches, "matched"), keys, "left"))


def _rates(j: DataFrame) -> DataFrame:
    j, one = j.na.fill(0, ["golden", "extracted", "matched"]), F.lit(1.0)
    return j.withColumn("precision", F.coalesce(F.try_divide(F.col("matched").cast("double"), F.col("extracted")), one)).withColumn("recall", F.coalesce(F.try_divide(F.col("matched").cast("double"), F.col("golden")), one))


def missed(gold: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    return gold.join(matches.select(*keys, "gi"), [*keys, "gi"], "left_anti")


def spurious(found: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    return found.join(matches.select(*keys, "ei"), [*keys, "ei"], "left_anti")


def gate(cards: DataFrame, entity: str, recall: float = 0.9) -> DataFrame:
    """(entity, golden, matched, recall, passed) over all meetings; entities without golden records pass."""
    g = cards.groupBy(entity).agg(F.sum("golden").alias("golden"), F.sum("matched").alias("matched"))
    r = F.coalesce(F.try_divide(F.col("matched").cast("double"), F.col("golden")), F.lit(1.0))
    return g.withColumn("recall", r).withColumn("passed", (F.col("golden") == 0) | (r >= recall))


# The fields that make an entity's match key, and those that are compared.
KEY_FIELDS = {"liquor_licenses": ("applicant_name", "address"), "cannabis_licenses": ("applicant_name", "address"), "votes": ("motion_text",), "public_speakers": ("name", "topic"), "traffic_incidents": ("victim_name", "location")}
COMPARED = {
    "liquor_licenses": ("applicant_name", "dba", "address", "application_type", "license_class", "committee_recommendation", "board_action"),
    "votes": ("topic_category", "outcome", "yes", "no", "abstain", "recusal"),
    "public_speakers": ("name", "affiliation", "position"),
    "traffic_incidents": ("victim_name", "location", "severity"),
    "cannabis_licenses": ("applicant_name", "address", "application_type"),
}
#: The first of these that a record has stands for it in lists, cut to 80 characters.
SUMMARY = ("applicant_name", "motion_text", "name", "victim_name", "location")


def side(df: DataFrame, entity: str, id_col: str, number: str) -> DataFrame:
    """(meeting_id, entity, number, key, summary, fields) of one entity's records; number is 'gi' for golden, 'ei' for extracted ones."""
    types = dict(df.dtypes)
    single = KEY_FIELDS[entity] == ("motion_text",)
    key = normalize_key(F.col("motion_text")) if single else match_key(*[F.col(c) for c in KEY_FIELDS[entity]])
    one = lambda c: F.struct(F.lit(c).alias("name"), F.lit(types[c] == "string").alias("text"), F.col(c).cast("string").alias("value"))
    named = [F.when(F.trim(F.col(c)) != "", F.col(c)) for c in SUMMARY if types.get(c) == "string"]
    return df.select("meeting_id", F.lit(entity).alias("entity"), F.col(id_col).alias(number), key.alias("key"), F.substring(F.coalesce(*named, F.lit("")), 1, 80).alias("summary"), F.array(*[one(c) for c in COMPARED[entity]]).alias("fields"))


def field_errors(gold: DataFrame, found: DataFrame, matches: DataFrame) -> DataFrame:
    """(meeting_id, entity, gi, name, golden, extracted, correct): one row for each compared field of each match."""
    keys = ["meeting_id", "entity"]
    m = matches.select(*keys, "gi", "ei").join(gold.select(*keys, "gi", F.col("fields").alias("_g")), [*keys, "gi"]).join(found.select(*keys, "ei", F.col("fields").alias("_e")), [*keys, "ei"])
    f = m.select(*keys, "gi", F.explode(F.arrays_zip("_g", "_e")).alias("z")).select(*keys, "gi", "z._g.name", "z._g.text", F.col("z._g.value").alias("golden"), F.col("z._e.value").alias("extracted"))
    g, e = F.col("golden"), F.col("extracted")
    return f.select(*keys, "gi", "name", "golden", "extracted", F.when(F.col("text"), field_correct(g, e, True)).otherwise(field_correct(g, e, False)).alias("correct"))


def report(gold: DataFrame, found: DataFrame, matches: DataFrame) -> DataFrame:
    """The scorecard of every meeting and entity with field accuracy and the lists of missed, spurious and wrong; where both sides are empty there is no row."""
    keys = ["meeting_id", "entity"]
    matches = cut(matches)  # needed four times
    if small_enough(matches, 50_000):
        matches = F.broadcast(matches)
    told = field_errors(gold, found, matches)
    wrong = F.when(~F.col("correct"), F.format_string("%s[%s].%s: golden=%s extracted=%s", "entity", F.col("gi").cast("string"), "name", F.coalesce("golden", F.lit("null")), F.coalesce("extracted", F.lit("null"))))
    fields = told.groupBy(*keys).agg(F.count_if("correct").alias("_c"), F.count(F.lit(1)).alias("_t"), F.sort_array(F.collect_list(wrong)).alias("field_errors"))
    none = F.array().cast("array<string>")

    def counted(df: DataFrame, number: str, n: str, alone: str) -> DataFrame:
        """All records of one side and the summaries of those without a match, from one reading."""
        there = df.join(matches.select(*keys, number, F.lit(True).alias("_in")), [*keys, number], "left")
        return there.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.sort_array(F.collect_list(F.when(F.col("_in").isNull(), F.col("summary")))).alias(alone))

    cards = counted(gold, "gi", "golden", "missed").join(counted(found, "ei", "extracted", "spurious"), keys, "full")
    j = _rates(cards.join(matches.groupBy(*keys).agg(F.count(F.lit(1)).alias("matched")), keys, "left")).join(fields, keys, "left")
    accuracy = F.coalesce(F.try_divide(F.col("_c").cast("double"), F.col("_t")), F.lit(1.0))
    return j.select(*keys, "golden", "extracted", "matched", "precision", "recall", accuracy.alias("field_accuracy"), *[F.coalesce(c, none).alias(c) for c in ("missed", "spurious", "field_errors")])


def roll_up(cards: DataFrame, least: float = 0.9) -> DataFrame:
    """(entity, golden, extracted, matched, precision, recall, field_accuracy, passed) over all meetings; field accuracy is weighted by matched records."""
    total = [F.sum(c).alias(c) for c in ("golden", "extracted", "matched")]
    g = cards.groupBy("entity").agg(*total, F.sum(F.col("field_accuracy") * F.col("matched")).alias("_f"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(1.0))
    g = g.select("entity", "golden", "extracted", "matched", share("matched", "extracted").alias("precision"), share("matched", "golden").alias("recall"), share("_f", "matched").alias("field_accuracy"))
    return g.withColumn("passed", (F.col("golden") == 0) | (F.col("recall") >= least))


def tally_gate(gold_votes: DataFrame, found_votes: DataFrame, matches: DataFrame) -> DataFrame:
    """(total, exact, rate, passed): whether every matched vote has the same four counts; nothing matched passes."""
    n = ["yes", "no", "abstain", "recusal"]
    a = gold_votes.select("meeting_id", F.col("vote_id").alias("gi"), *[F.col(c).alias(f"_a{c}") for c in n])
    b = found_votes.select("meeting_id", F.col("vote_id").alias("ei"), *[F.col(c).alias(f"_b{c}") for c in n])
    j = matches.filter("entity = 'votes'").select("meeting_id", "gi", "ei").join(a, ["meeting_id", "gi"]).join(b, ["meeting_id", "ei"])
    t = j.agg(F.count(F.lit(1)).alias("total"), F.count_if(tallies_exact([F.col(f"_a{c}") for c in n], [F.col(f"_b{c}") for c in n])).alias("exact"))
    rate = F.coalesce(F.try_divide(F.col("exact").cast("double"), F.col("total")), F.lit(1.0))
    return t.select("total", "exact", rate.alias("rate"), (F.col("exact") == F.col("total")).alias("passed"))


def render(totals: list, tally) -> str:
    """The rolled-up scorecard as lines of text; totals and tally are the collected rows of `roll_up` and `tally_gate`, a handful."""
    lines = [f"{'entity':<20}{'golden':>8}{'found':>8}{'matched':>9}{'precision':>11}{'recall':>8}{'fields':>8}"]
    lines += [f"{r.entity:<20}{r.golden:>8}{r.extracted:>8}{r.matched:>9}{r.precision:>11.0%}{r.recall:>8.0%}{r.field_accuracy:>8.0%}" for r in sorted(totals, key=lambda r: r.entity)]
    failed = [f"{r.entity} recall {r.recall:.0%}" for r in totals if not r.passed] + ([] if tally.passed else [f"tallies {tally.exact} of {tally.total}"])
    return "\n".join([*lines, f"tallies {tally.exact}/{tally.total}", "FAILED: " + "; ".join(failed) if failed else "PASSED"])


def exit_code(totals: list, tally, found_any: bool = True) -> int:
    """0 where every gate is passed, 1 where one is not, 2 where there was nothing to evaluate."""
    return 2 if not found_any or not totals else int(not (tally.passed and all(r.passed for r in totals)))
