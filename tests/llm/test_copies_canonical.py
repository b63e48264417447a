import random

import pytest

from gavel.llm import canonical, formatting_copies as fc

FIELDS = {"a": "party", "b": "party", "c": "place"}
SCHEMA = "id bigint, g string, a string, b string, c string, copies string"


def bare(x):
    return "".join(ch for ch in (x or "").lower() if ch.isalnum())


def brute(rows):
    groups = {}
    for r in {x[0]: x for x in rows if x[0] is not None and x[1] is not None}.values():
        groups.setdefault((r[1], tuple(sorted((bare(r[2]), bare(r[3])))), bare(r[4])), []).append(r[0])
    return {(min(g), i) for g in groups.values() for i in g if i != min(g)}


def test_found_equals_brute_force(spark):
    rnd = random.Random(4)
    word = lambda: rnd.choice(["Ab c", "AB-C", "abd", "", None, "éa", "ÉA", "..", "x" * 5000])
    rows = [(i, rnd.choice(["m1", "m2", None]), word(), word(), word(), "z") for i in range(300)]
    rows += rows[:20]  # delivered twice
    got = {tuple(r) for r in fc.found(spark.createDataFrame(rows, SCHEMA), "id", ["g"], FIELDS).collect()}
    assert got == brute(rows)


def test_records_that_share_a_fingerprint_by_accident(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(fc, "_sum_of_hashes", lambda pairs, salt: F.size(pairs).cast("bigint"))
    rows = [(i, "m", a, b, c, "") for i, (a, b, c) in enumerate([("a", "b", "p"), ("B", "A", "p"), ("c", None, "p"), ("", "C.", "p"), ("a", "b", "q"), ("d", "d", "p"), ("b", "a", "Q")])]
    assert {tuple(r) for r in fc.found(spark.createDataFrame(rows, SCHEMA), "id", ["g"], FIELDS).collect()} == brute(rows)


def test_swapped_fields_are_one_but_not_place(spark):
    rows = [(1, "m", "A", "B", "C", ""), (2, "m", "b.", "a", "c", ""), (3, "m", "c", "b", "a", ""), (4, "n", "A", "B", "C", "")]
    assert {tuple(r) for r in fc.found(spark.createDataFrame(rows, SCHEMA), "id", ["g"], FIELDS).collect()} == {(1, 2)}


def test_collapse_keeps_columns_and_counts(spark):
    rows = [(1, "m", "A", None, "C", "own"), (2, "m", "a", "", "c!", "own"), (3, "m", "d", "", "c", None)]
    r = {x.id: (x.copies, x.copies_count) for x in fc.collapse(spark.createDataFrame(rows, SCHEMA), "id", ["g"], FIELDS).collect()}
    assert r == {1: ("own", 2), 3: (None, 1)}


def test_copies_of_an_empty_table(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert fc.found(e, "id", ["g"], FIELDS).count() == 0 and fc.collapse(e, "id", ["g"], FIELDS).count() == 0


def test_one_hot_group(spark):
    rows = [(i, "m", "Same Name", "x", "p", "") for i in range(3000)] + [(5000 + i, "m", f"n{i}", "x", "p", "") for i in range(100)]
    got = fc.found(spark.createDataFrame(rows, SCHEMA), "id", ["g"], FIELDS)
    assert got.count() == 2999 and got.filter("first_id <> 0").count() == 0


CANON = [(1, "f", "Approved"), (2, "f", "Denied"), (3, "t", "Live music"), (4, "t", "DJ")]


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_pigeonhole_loses_nothing(spark):
    """Random edits: the segment join finds exactly what comparing everything finds."""
    rnd = random.Random(9)
    refs = ["approved", "denied", "not approved", "passed by all", "ok"]
    texts = []
    for _ in range(400):
        s = list(rnd.choice(refs))
        for _ in range(rnd.randrange(0, 6)):
            k = rnd.randrange(len(s) + 1)
            s[k : k + rnd.randrange(2)] = rnd.choice(["", "e", "zz", "a"])
        texts.append("".join(s))
    texts = sorted({t for t in texts if t.strip()})
    got = canonical.near(spark.createDataFrame([("f", t) for t in texts], "field string, text string"), spark.createDataFrame([("f", r) for r in refs], "field string, ref string"), canonical.EDITS)
    k = lambda n: 0 if n < 3 else 1 if n < 5 else 2 if n < 15 else 3
    assert {(r.text, r.ref, r.d) for r in got.collect()} == {(t, r, lev(t, r)) for t in texts for r in refs if lev(t, r) <= k(len(r))}


def test_words_in_any_order_short_or_mistyped(spark):
    """Labels and wordings of another trade than the tables': the method has no list of answers."""
    canon = [(1, "s", "Shipped by air freight"), (2, "s", "Returned to sender"), (3, "s", "Lost in warehouse"), (4, "s", "Held at customs")]
    want = {"air freight, shipped": 1, "shpd air frt": 1, "freight by air": 1, "sender: retuned": 2, "warehouse lost it": 3, "lost (whse.)": 3, "customs hold": 4, "customs - held": 4, "paid in full": 0, "12/4": 0, "the weather was fine": 0, "": None}
    rows = [(i, "s", 0, v) for i, v in enumerate(want)]
    typed = canonical.typed_values(spark.createDataFrame([(i, v) for i, (_, _, _, v) in enumerate(rows)], "id bigint, s string"), "id", ["s"], [])
    for words in (["hold held", "ship shipped"], []):
        got = {r.id: r.canon_id for r in canonical.map_values(typed, spark.createDataFrame(canon, "canon_id bigint, field string, label string"), words).collect()}
        wrong = {v: got.get(i) for i, (v, c) in enumerate(want.items()) if got.get(i) != c}
        assert not wrong, wrong


def test_typed_values_and_positions(spark):
    rows = [(1, "Approved", ["dj", None, " ", "MUSIC, LIVE (3-0-1)"], "x"), (2, "  ", None, "x"), (3, None, [], "x"), (4, "item 3: aproved - 7/25", ["nothing like it"], "x"), (4, "item 3: aproved - 7/25", ["nothing like it"], "x"), (5, "z" * 20000, ["L1ve mus1c "], "x")]
    t = canonical.typed_values(spark.createDataFrame(rows, "id bigint, f string, t array<string>, canon_id string"), "id", ["f"], ["t"])
    m = canonical.map_values(t, spark.createDataFrame(CANON, "canon_id bigint, field string, label string"))
    got = sorted((r.id, r.field, r.pos, r.canon_id) for r in m.distinct().collect())
    assert got == [(1, "t", 1, 4), (1, "t", 4, 3), (4, "f", 0, 1), (4, "t", 1, 0), (5, "f", 0, 0), (5, "t", 1, 3)]


def test_no_values(spark):
    t = spark.createDataFrame([], "id bigint, field string, pos bigint, value string")
    assert canonical.map_values(t, spark.createDataFrame(CANON, "canon_id bigint, field string, label string")).count() == 0


def test_empty_thesaurus_and_empty_list(spark):
    t = spark.createDataFrame([(1, "f", 0, "aproved"), (2, "x", 0, "Approved")], "id bigint, field string, pos bigint, value string")
    canon = spark.createDataFrame(CANON, "canon_id bigint, field string, label string")
    assert {(r.id, r.canon_id) for r in canonical.map_values(t, canon, []).collect()} == {(1, 1), (2, 0)}
    assert {r.canon_id for r in canonical.map_values(t, canon.limit(0)).collect()} == {0}
