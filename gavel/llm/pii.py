"""Personal details in free text: found by a character tagger, replaced by typed placeholders.

The tagger is the bidirectional LSTM with CRF transitions of `crf`, trained by `pii_train` on composed sentences; its
weights (`pii_model.npz`, about 200 KB) lie beside this file and are broadcast. Long texts are scored in overlapping
windows whose scores are merged by distance from the window edge, and every text is decoded once over the merged
scores, so a detail across a window edge is one detail. A short exact check follows each decoded span: it trims titles,
possessive endings and final periods, and drops spans that cannot be of their kind (an e-mail without a sign for "at",
a telephone number without enough digits).

Scale: one scan, Arrow batches sorted by length inside the scorer, no shuffle; equal texts inside a batch are scored
once. Memory is bounded by the batch, whatever the length of the texts: windows are scored 256 at a time.

Defined cases: null, empty and blank texts have no details and stay as they are under redaction; the same detail twice
in one field is two spans and one row of `details`; rows delivered twice give the same details; empty tables give empty
results; further columns are kept by `redact` and ignored by `details`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crf import Tagger

WEIGHTS = Path(__file__).with_name("pii_model.npz")
_TITLE = re.compile(r"^(?:(?:mr|mrs|ms|mx|dr|hon|rev|sen|prof|sr|sra|councilmember|council member|pani|pan|señora?|sir|madam)\b\.?,?\s+)+", re.I)
_AFTER = re.compile(r"(?:,?\s+(?:esq|phd|ph\.d|md|m\.d|jr|sr|iii|ii)\.?|\s*\(.*\)?|['’]s?)+$", re.I)
_SPOKEN = re.compile(r"\b(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)\b", re.I)
#: Characters of texts scored together.
_CHUNK = 400_000


def tidy(kind: str, text: str, start: int, end: int) -> tuple[int, int] | None:
    """The exact bounds of a decoded span, or None where it cannot be of its kind."""
    s = text[start:end]
    lead = len(s) - len(s.lstrip(" ,;:\n\t\"“‘'" + (")]" if kind == "phone" else "([)]")))
    s = s[lead:]
    if kind == "name":
        m = _TITLE.match(s)
        if m:
            lead += m.end()
            s = s[m.end() :]
        s = _AFTER.sub("", s)
    s = re.sub(r"[\s,;:.\"”]+$", "", s)
    while s.startswith("(") and s.count("(") > s.count(")"):
        s, lead = s[1:], lead + 1
    if s.endswith(")") and s.count("(") < s.count(")"):
        s = s[:-1]
    digits = sum(c.isdigit() for c in s)
    ok = {
        "email": bool(re.search(r"@|\bat\b|_at_|[(\[{]a[)\]}]|arroba|małpa", s, re.I)) and len(s) > 5,
        "phone": digits >= 7 or len(_SPOKEN.findall(s)) + digits >= 7,
        "id_number": digits >= 6,
        "address": digits >= 1 and s[:1].isdigit() and any(c.isalpha() for c in s),
        "name": digits <= 2 and sum(c.isalpha() for c in s) >= 2,
    }[kind]
    return (start + lead, start + lead + len(s)) if ok and s else None


def spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of each detail of each text."""
    order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
    out: list = [[] for _ in texts]
    block: list[int] = []
    size = 0

    def flush() -> None:
        for k, found in zip(block, tagger.spans([texts[k] for k in block])):
            out[k] = [(kind, *t) for kind, a, b in found if (t := tidy(kind, texts[k], a, b))]

    for k in order:
        if block and size + len(texts[k]) > _CHUNK:
            flush()
            block, size = [], 0
        block.append(k)
        size += len(texts[k])
    if block:
        flush()
    return out


def _tagger(df: DataFrame):
    return df.sparkSession.sparkContext.broadcast(WEIGHTS.read_bytes())


def details(df: DataFrame, id_col: str, text_cols: dict[str, str]) -> DataFrame:
    """(field, record_id, kind, found): the distinct details of each text column. text_cols: column -> field name."""
    shared = _tagger(df)
    # one row a text, so that the columns share batches; blank texts never reach Python
    texts = F.explode(F.array(*[F.struct(F.lit(name).alias("f"), F.col(c).alias("t")) for c, name in text_cols.items()]))
    src = df.select(F.col(id_col).cast("bigint").alias("i"), texts.alias("s")).select("i", "s.f", "s.t").filter("length(trim(t)) > 0")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger.load(shared.value)
        for b in batches:
            distinct = list(dict.fromkeys(b["t"]))
            of = {t: dict.fromkeys((k, t[x:y]) for k, x, y in s) for t, s in zip(distinct, spans(tagger, distinct))}
            rows = [(f, i, k, x) for f, i, t in zip(b["f"], b["i"], b["t"]) for k, x in of[t]]
            yield pd.DataFrame(rows, columns=["field", "record_id", "kind", "found"])

    found = src.mapInPandas(scan, "field string, record_id bigint, kind string, found string")
    return found.distinct()


def redact(df: DataFrame, text_cols: list[str]) -> DataFrame:
    """The table with every detail of the given columns replaced by [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] or [NAME]."""
    shared = _tagger(df)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = Tagger.load(shared.value)
        for b in batches:
            distinct = [t for t in dict.fromkeys(b) if t and t.strip()]
            new = {}
            for t, found in zip(distinct, spans(tagger, distinct)):
                parts, at = [], 0
                for kind, x, y in found:
                    parts += [t[at:x], f"[{kind.upper()}]"]
                    at = y
                new[t] = "".join(parts) + t[at:]
            yield b.map(lambda t: new.get(t, t))

    return df.withColumns({c: clean(F.col(c)) for c in text_cols})
