"""Costly predictors (a language model, a vision reader) behind an interface that survives retries.

A predictor is called once a key: finished keys are left out by an anti-join, results are kept in a table by key, and a
failure is an error text in its row. Invalid answers get one second pass with what was wrong with them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def work_list(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return items.join(done.select(*keys), keys, "left_anti")


def predict(items: DataFrame, key: str, prompt: str, make: Callable[[], Callable[[str], str]]) -> DataFrame:
    """(key, answer, error). make() builds the predictor once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make()
        for b in batches:
            rows = []
            for k, p in zip(b["k"], b["p"]):
                try:
                    rows.append((k, call(p), None))
                except Exception as e:  # noqa: BLE001  one record's failure is its own
                    rows.append((k, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["key", "answer", "error"])

    return items.select(F.col(key).cast("string").alias("k"), F.col(prompt).alias("p")).mapInPandas(run, "key string, answer string, error string")


def with_retry(items: DataFrame, key: str, prompt: str, make: Callable, check: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, answer, error, attempt). check adds `problem` (null where valid) to answers; keep writes a pass down before the next."""
    first = keep(check(predict(items, key, prompt, make)))
    again = items.join(first.filter("problem IS NOT NULL").select(F.col("key").alias("_k"), "problem"), F.col(key).cast("string") == F.col("_k"))
    second = keep(check(predict(again.withColumn(prompt, F.concat(F.col(prompt), F.lit("\n\nThe last answer was not valid: "), F.col("problem"))), key, prompt, make)))
    ok = first.filter("problem IS NULL").withColumn("attempt", F.lit(1))
    return ok.unionByName(second.withColumn("attempt", F.lit(2)))


def tiered(items: DataFrame, cheap: Callable[[DataFrame], DataFrame], costly: Callable[[DataFrame], DataFrame], answer: str) -> DataFrame:
    """The cheap result where it has an answer; only the rest goes to the costly one. Both keep the columns of the cheap result."""
    c = cheap(items)
    return c.filter(F.col(answer).isNotNull()).unionByName(costly(c.filter(F.col(answer).isNull()).drop(answer)))


def build_prompt(body: str, template: str, most: int = 350_000):
    """STRUCT<prompt, warning>: a template with %s for the text, and a warning where the text had to be cut to the model's limit."""
    t = F.col(body)
    return F.struct(F.format_string(template, F.substring(t, 1, most)).alias("prompt"), F.when(F.length(t) > most, F.lit(f"body cut to {most} characters")).alias("warning"))


def parts(text: str, most: int = 350_000, boundary: str = r"(?=^\[page [^\]\n]*\]\n)") -> list[str]:
    """The whole text in stretches of at most `most` characters, divided at page tags; only a page longer than that is divided itself, at a blank."""
    out = [""]
    for page in re.split(boundary, text, flags=re.M):
        if len(out[-1]) + len(page) <= most:
            out[-1] += page
            continue
        while len(page) > most:
            cut = max(page.rfind(" ", 0, most), page.rfind("\n", 0, most)) + 1 or most
            out.append(page[:cut])
            page = page[cut:]
        out.append(page)
    return [p for p in out if p] or [text]


def body_parts(body: str, most: int = 350_000):
    """ARRAY<STRING>: the parts of a body, in order."""

    @F.pandas_udf("array<string>")
    def divide(t: pd.Series) -> pd.Series:
        return t.map(lambda x: None if x is None else parts(x, most))

    return divide(F.col(body))


def text_source(pages: str, scanned: str, year: str):
    """vision_ocr, mixed, embedded_ocr or native, from how many body pages were read by vision and the year."""
    p, s = F.col(pages), F.col(scanned)
    return F.when((p > 0) & (s >= p), "vision_ocr").when(s > 0, "mixed").when(F.col(year) < 2022, "embedded_ocr").otherwise("native")
