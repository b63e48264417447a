"""Every registered analytical query against its SQL form, on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from gavel.plans import catalogue

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime) and v.tzinfo:
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in SQL:
        return
    cur = con.execute(SQL[name])
    have = [x[0] for x in cur.description]
    rows = cur.fetchall()
    assert sorted(have) == cols
    at = [have.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def test_no_nested_loops_or_row_udfs(spark):
    for name in ("opposed_denied", "division_panel", "band_sweep", "contested_by_topic"):
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "BatchEvalPython" not in plan, name


def _small(spark, path, docs):
    """Tables of three meetings in three years and the given documents."""
    spark.createDataFrame([("a", datetime.date(2015, 2, 1)), ("b", datetime.date(2018, 2, 1)), ("c", datetime.date(2024, 2, 1)), ("d", None)], "meeting_id string, date date").write.parquet(f"{path}/meetings.parquet")
    spark.createDataFrame(docs, "doc_id int, meeting_id string, page_no int, text string").write.parquet(f"{path}/documents.parquet")
    c = duckdb.connect()
    for t in ("meetings", "documents"):
        c.execute(f"create view {t} as select * from '{path}/{t}.parquet/*.parquet'")
    return c


def test_mentions_of_every_year(spark, tmp_path):
    """Every year that has meetings is a column, with and without mentions."""
    c = _small(spark, tmp_path, [(1, "a", 1, "Dog run, dog run."), (2, "c", 1, "composting and a DOG RUN"), (3, "d", 1, "dog run")])
    r = QUERIES["mention_pivot_years"](spark, str(tmp_path))
    got = {x.term: (x.y2015, x.y2018, x.y2024) for x in r.collect()}
    assert r.columns == ["term", "y2015", "y2018", "y2024"]
    assert got == {"bike corral": (0, 0, 0), "dog run": (2, 0, 1), "street vendor": (0, 0, 0), "composting": (0, 0, 1)}
    assert {x[0]: x[1:] for x in c.execute(SQL["mention_pivot_years"]).fetchall()} == got


def test_every_mention_has_its_context(spark, tmp_path):
    text = "Petition one. " + "x" * 300 + " a PETITION\n two " + "y" * 300 + " petitionpetition" + "z" * 300
    c = _small(spark, tmp_path, [(1, "a", 1, text), (2, "a", 2, "nothing"), (3, "b", 1, None), (4, "b", 2, "the petition")])
    got = sorted(map(tuple, QUERIES["kwic_all"](spark, str(tmp_path)).select("doc_id", "k", "context").collect()))
    at = [i for i in range(len(text)) if text[i : i + 8].lower() == "petition"]
    assert got == [(1, k + 1, " ".join(text[max(0, p - 180) : p + 188].split())) for k, p in enumerate(at)] + [(4, 1, "the petition")] and len(at) == 4
    assert sorted(c.execute("SELECT doc_id, k, context FROM (" + SQL["kwic_all"] + ")").fetchall()) == got
