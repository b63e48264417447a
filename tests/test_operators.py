import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gavel.functions import columns as C
from gavel.functions import filenames as N
from gavel.functions import fuzzy as Z
from gavel.operators import bandjoin, evaluate, fulltext, graph, grouping, pages, predict, statistics
from gavel.operators.components import connected_components
from gavel.operators.ledger import cost, guard
from gavel.sources import loader, readers, schemas
from gavel.streaming import ledger as stream


def test_components_match_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(7, 7), (1000 + 0, 1001)] + [(2000 + i, 2001 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    want = {x: find(x) for e in edges for x in e if any(y != e[0] for y in e) or any(x in f and f[0] != f[1] for f in edges)}
    assert got == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_canonical_names_skip_no_pair(spark):
    """As by comparing every name with every head before it, whatever the last word begins with."""
    rnd = random.Random(5)
    people = ["percy felerigh", "yusuf pipipeman", "P. Felerigh", "anna-maria oldenburg", "ann oldenburg", "annabel westerhouse", "quentin harrowgate", "bo li"]
    rows = {"percy fele righ": 2, "pipipeman yusuf f": 3, "pipipeman, yusuf": 2, "quentin harrowgate jr": 2, "quentin barrowgate": 2, "  bo lin": 1}
    for p in people:
        rows[p] = 9
        for _ in range(25):
            k = rnd.randrange(len(p))
            rows.setdefault(rnd.choice([p[:k] + p[k + 1 :], p[:k] + rnd.choice("abo .") + p[k:], p + " " + rnd.choice("fjx")]), rnd.randrange(1, 6))
    heads, want = [], {}
    for name in sorted(rows, key=lambda x: (-rows[x], x)):
        low = name.lower()
        first = low.split()[0].rstrip(".")
        hit = next((h for h, f in heads if f[:1] == first[:1] and (f.startswith(first) or first.startswith(f)) and Z.indel(low, h.lower()) >= 90), None)
        if hit is None:
            heads.append((name, first))
        want[name] = hit or name
    got = {r.name: r.canonical for r in graph.canonical_names(spark.createDataFrame(list(rows.items()), "name string, n int")).collect()}
    assert got == want
    assert got["percy fele righ"] == "percy felerigh" and got["pipipeman, yusuf"] == "pipipeman yusuf f" and got["quentin barrowgate"] == "quentin harrowgate"
    vetoed = graph.canonical_names(spark.createDataFrame(list(rows.items()), "name string, n int"), veto={("percy fele righ", "percy felerigh")}).collect()
    assert {r.name: r.canonical for r in vetoed}["percy fele righ"] != "percy felerigh"


def test_band_pairs_equal_the_plain_join(spark):
    rnd = random.Random(1)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(700))
    left = [(i, rnd.choice("ab"), day()) for i in range(60)] + [(60, "a", None)]
    right = [(i, rnd.choice("ab"), day()) for i in range(80)] + [(80, "a", None)]
    for w in (0, 1, 30, 90):
        want = {(a, b) for a, k, x in left for b, q, y in right if x and y and k == q and 0 <= (x - y).days <= w}
        p = bandjoin.band_pairs(spark.createDataFrame(left, "a int, k string, x date"), spark.createDataFrame(right, "b int, k string, y date"), "x", "y", w, ["k"])
        assert {(r.a, r.b) for r in p.collect()} == want and p.count() == len(want)


@pytest.mark.parametrize(
    "name, day, y, m",
    [("log-20181509", None, None, None), ("log 3_7_14", "2014-03-07", None, None), ("june-31-2015", None, 2015, 6), ("q_4172018_q", "2018-04-17", None, None), ("log_1232019", None, None, None), ("nov2013", None, 2013, 11), ("log-20190228-2", "2019-02-28", None, None), ("", None, None, None)],
)
def test_filename_dates(spark, name, day, y, m):
    r = spark.createDataFrame([(name,)], "s string").select(N.filename_date(F.col("s")).alias("d")).first().d
    assert (str(r.day) if r.day else None) == day
    if m:
        assert (r.y, r.m) == (y, m)


@pytest.mark.parametrize(
    "text, day",
    [("Sent May 30, 2015. Minutes of the session held April 2, 2015", "2015-04-02"), ("PUBLIC HEARING\non\nAUGUST\n9,\n2018", "2018-08-09"), ("minutes of 11/3/2017", "2017-11-03"), ("MARCH 4, 201788 BOARD MEETING", None), ("nothing", None), (None, None)],
)
def test_first_page_dates(spark, text, day):
    r = spark.createDataFrame([(text,)], "s string").select(N.first_page_date(F.col("s")).alias("d")).first().d
    assert (str(r) if r else None) == day


def test_group_files_keeps_revisions_and_orders_parts(spark):
    names = ["log-20190704-part-2.pdf", "log-20190704-part-1.pdf", "log-20190704-part-2-revised.pdf", "log-20190704.pdf", "loose-4.pdf"]
    g = grouping.group_files(grouping.parse_files(spark.createDataFrame(list(enumerate(names)), "ord int, href string")), "m").collect()
    assert len(g) == 1 and g[0].files == ["log-20190704-part-1.pdf", "log-20190704-part-2-revised.pdf", "log-20190704.pdf"] and g[0].is_revised
    assert g[0].warnings == ["kept revised over plain for part 2", "a file without a part number beside numbered parts"]


def test_page_labels(spark):
    dense = "The motion was seconded by the committee chairperson. " * 20
    rows = [("  ", "blank"), (dense, "body"), ("ROLL CALL: YES NO ABS REC", "vote_sheet"), ("dear sir sincerely yours www.x", "attachment"), (None, "blank"), ("x x x x x x tally of members", "vote_sheet")]
    got = spark.createDataFrame(rows, "t string, want string").select("want", pages.classify(F.col("t"))["label"].alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_smoothing_needs_both_sides(spark):
    rows = [("f", 1, "body", 0.9), ("f", 2, "attachment", 0.4), ("f", 3, "body", 0.85), ("g", 1, "body", 0.9), ("g", 2, "attachment", 0.4), ("g", 3, "vote_sheet", 0.95), ("g", 4, "attachment", 0.4)]
    r = pages.smooth(spark.createDataFrame(rows, "f string, p int, label string, confidence double"), "f", "p").collect()
    assert {(x.f, x.p): (x.label, x.smoothed) for x in r if x.confidence < 0.8} == {("f", 2): ("body", True), ("g", 2): ("attachment", False), ("g", 4): ("attachment", False)}


def test_fuzzy_against_plain_subsequence():
    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rnd = random.Random(5)
    for _ in range(200):
        a, b = ("".join(rnd.choice("abc ") for _ in range(rnd.randrange(1, 90))) for _ in range(2))
        assert abs(Z.indel(a, b) - 200 * lcs(a, b) / (len(a) + len(b))) < 1e-9


def _plain_token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max([Z.indel(one, two)] + ([Z.indel(both, one), Z.indel(both, two)] if both else []))


def _random_keys(rnd, n):
    word = lambda: "".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 30))) if rnd.random() < 0.5 else rnd.choice("harbor light annex street qx a ab 12 00157".split())
    return [" ".join(word() for _ in range(rnd.randrange(9))) or " " for _ in range(n)] + ["x" * 400 + " y", "x" * 390 + " z z"]


def test_block_scores_against_all_pairs():
    """The bounds rule out no pair, and what they leave is scored as before: few and many pairs, long keys, keys without words, several groups."""
    rnd = random.Random(2)
    for n, m in ((1, 1), (7, 9), (80, 70)):
        left, right, ends, want = [], [], [], []
        for _ in range(3):
            a, b = _random_keys(rnd, n), _random_keys(rnd, m)
            want += [(i + len(left), j + len(right), _plain_token_set(x, y)) for i, x in enumerate(a) for j, y in enumerate(b)]
            left, right = left + a, right + b
            ends.append((len(left), len(right)))
        for least in (0.0, 40.0, 75.0, 100.0):
            got = list(zip(*(x.tolist() for x in evaluate.block_scores(left, right, ends, least))))
            assert sorted(got) == [x for x in want if x[2] >= least]


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    """One group's pairs are more than one row, so that several tasks share them; ids of any type and null ids go through."""
    rnd = random.Random(3)
    a = [("m", f"g{i}" if i else None, k) for i, k in enumerate(_random_keys(rnd, 40))] + [("n", "x", "one two"), (None, "y", "one two"), ("o", "z", "")]
    b = [("m", i, k) for i, k in enumerate(_random_keys(rnd, 50))] + [("n", 1, "two one"), (None, 2, "one two"), ("o", 3, "")]
    g, f = spark.createDataFrame(a, "k string, gi string, key string"), spark.createDataFrame(b, "k string, ei bigint, key string")
    want = sorted((k, i or "", j, s) for k, i, x in a for l, j, y in b if k and k == l and x and y and (s := _plain_token_set(x, y)) >= 75)
    monkeypatch.setattr(evaluate, "BLOCK", 7)
    assert evaluate._blocks(g.filter("key <> ''"), ["k"], "gi", "key").filter("k = 'm'").count() > 3
    c = evaluate.candidates(g, f, ["k"])
    assert c.dtypes == [("k", "string"), ("gi", "string"), ("ei", "bigint"), ("score", "double")]
    assert sorted((r.k, r.gi or "", r.ei, r.score) for r in c.collect()) == want


def test_block_scores_of_short_keys_against_all_pairs():
    """Groups of a few pairs are taken together, those of many one by one; keys under and over 64 characters, words common on either side."""
    rnd = random.Random(8)
    key = lambda n: " ".join(rnd.choice(["harbor", "light", "street", "qx", "".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 12)))]) for _ in range(rnd.randrange(n)))
    left, right, ends, want = [], [], [], []
    for m, n in ((3, 5), (0, 4), (150, 140), (1, 1), (60, 70)):
        a, b = [key(rnd.choice([4, 9, 30])) for _ in range(m)], [key(rnd.choice([4, 9, 30])) for _ in range(n)]
        want += [(i + len(left), j + len(right), _plain_token_set(x, y)) for i, x in enumerate(a) for j, y in enumerate(b)]
        left, right = left + a, right + b
        ends.append((len(left), len(right)))
    for least in (0.0, 55.0, 75.0, 100.0):
        got = list(zip(*(x.tolist() for x in evaluate.block_scores(left, right, ends, least))))
        assert sorted(got) == [x for x in want if x[2] >= least]


def test_repeated_keys_are_scored_once(monkeypatch):
    """A group's key that stands in several records is held against the others once, and its score goes to all of them."""
    left, right = ["one two", "three four", "one two", "one two"], ["two one", "one two", "two one", "three four"]
    one, stops, *x = evaluate._distinct(left, [3, 4])
    two, halts, *y = evaluate._distinct(right, [3, 4])
    assert (one, stops, two, halts) == (["one two", "three four", "one two"], [2, 3], ["two one", "one two", "three four"], [2, 3])
    monkeypatch.setattr(evaluate, "PAIRS", 2)
    parts = list(evaluate._repeated(*evaluate.block_scores(one, two, list(zip(stops, halts)), 75.0), x, y))
    assert max(len(i) for i, _, _ in parts) == 2
    got = sorted((i, j, s) for p in parts for i, j, s in zip(*(c.tolist() for c in p)))
    assert got == [(i, j, 100.0) for i in (0, 2) for j in range(3)]


def test_keys_of_candidates_are_computed_once(spark):
    """Neither the count that cuts the blocks nor the empty keys left out compute a record's key again; empty and null keys have no pairs."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(x):
        calls.add(1)
        return x

    a = [("m", i, f"harbor light {i}") for i in range(40)] + [("m", 40, ""), ("m", 41, None), ("n", 42, "")]
    g = spark.createDataFrame(a, "k string, gi int, x string").withColumn("key", key("x"))
    f = spark.createDataFrame(a[:30] + a[40:], "k string, ei int, x string").withColumn("key", key("x"))
    pairs = {(r.k, r.gi, r.ei) for r in evaluate.candidates(g, f, ["k"]).collect()}
    assert {("m", i, i) for i in range(30)} <= pairs and not {gi for _, gi, _ in pairs} & {40, 41, 42}
    assert calls.value == 43 + 33


def _firms(rnd, n):
    word = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    return [f"{word(9)} {word(8)} kitchen partners llc {rnd.randrange(1000)} {word(11)} street {word(9)} qx" for _ in range(n)]


def test_bounds_leave_few_pairs_to_score(monkeypatch):
    """Of 200,000 pairs with many words in common few more are scored than pass."""
    keys, scored = _firms(random.Random(4), 500), []
    real = evaluate.word_sets
    monkeypatch.setattr(evaluate, "word_sets", lambda x, y: scored.append(1) or real(x, y))
    i, j, s = evaluate.block_scores(keys, keys[:400], [(500, 400)], 75.0)
    assert {(x, x) for x in range(400)} <= set(zip(i.tolist(), j.tolist())) and len(s) <= len(scored) <= len(s) + 200


def test_greedy_ties_take_the_larger_index(spark):
    p = spark.createDataFrame([("m", 0, 0, 90.0), ("m", 0, 1, 90.0), ("m", 1, 1, 80.0)], "k string, gi int, ei int, score double")
    assert {(r.gi, r.ei) for r in evaluate.greedy(p, ["k"]).collect()} == {(0, 1)}


def test_scorecard_and_gate(spark):
    gold = spark.createDataFrame([("m", "v", i) for i in range(10)], "m string, e string, gi int")
    found = spark.createDataFrame([("m", "v", i) for i in range(9)] + [("m", "w", 0)], "m string, e string, ei int")
    match = spark.createDataFrame([("m", "v", i, i) for i in range(8)], "m string, e string, gi int, ei int")
    c = {r.e: r for r in evaluate.scorecard(gold, found, match, ["m", "e"]).collect()}
    assert c["v"].recall == 0.8 and abs(c["v"].precision - 8 / 9) < 1e-9 and c["w"].recall == 1.0 and c["w"].precision == 0.0
    g = {r.e: r.passed for r in evaluate.gate(evaluate.scorecard(gold, found, match, ["m", "e"]), "e").collect()}
    assert g == {"v": False, "w": True}
    assert evaluate.missed(gold, match, ["m", "e"]).count() == 2 and evaluate.spurious(found, match, ["m", "e"]).count() == 2


def test_scorecard_of_a_meeting_in_blocks(spark, monkeypatch):
    """A meeting of several blocks on either side, and a small one beside it: every record counts once."""
    monkeypatch.setattr(evaluate, "BLOCK", 100)
    keys = _firms(random.Random(6), 600)
    g = spark.createDataFrame([("m", i, k) for i, k in enumerate(keys)] + [("n", 0, "harbor light annex"), ("n", 1, "")], "k string, gi int, key string")
    f = spark.createDataFrame([("m", i, k) for i, k in enumerate([*keys[:240], *(f"{i:060d}" for i in range(60))])] + [("n", 0, "harbor lights annex")], "k string, ei int, key string")
    m = evaluate.greedy(evaluate.candidates(g, f, ["k"]), ["k"])
    c = {r.k: (r.golden, r.extracted, r.matched, r.precision, r.recall) for r in evaluate.scorecard(g, f, m, ["k"]).collect()}
    assert c == {"m": (600, 300, 240, 0.8, 0.4), "n": (2, 1, 1, 1.0, 0.5)}


def test_fisher_and_t():
    odds, p = statistics.fisher_exact(8, 2, 1, 5)
    assert odds == 20.0 and abs(p - 0.03496503496503495) < 1e-9
    assert abs(statistics.t_two_sided(2.0, 10) - 0.07338803477074039) < 1e-9


def test_clustered_logit_finds_the_effect(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(1500):
        x = rnd.randrange(2)
        rows.append((float(rnd.random() < (0.7 if x else 0.3)), x, str(i % 40)))
    d, terms = statistics.design(spark.createDataFrame(rows, "y double, x int, c string"), "y", ["x"], {}, "c")
    r = {t["term"]: t for t in statistics.clustered_logit(d, terms)}
    spread = {t["term"]: t for t in statistics.clustered_logit(d, terms, max_patterns=0)}
    assert all(abs(r[t][c] - spread[t][c]) < 1e-9 for t in terms for c in ("coef", "se"))
    hi, lo = (sum(y for y, x, _ in rows if x == k) / sum(1 for _, x, _ in rows if x == k) for k in (1, 0))
    import math

    assert abs(r["x"]["coef"] - (math.log(hi / (1 - hi)) - math.log(lo / (1 - lo)))) < 1e-6 and 0.05 < r["x"]["se"] < 0.2 and r["x"]["p"] < 1e-6


def test_ledger_prices_and_guard(spark):
    rows = [(1, "d", 1_000_000, 1_000_000, 0, 0, False), (2, "d", 1_000_000, 1_000_000, 0, 0, True), (3, "e", 0, 0, 0, 1_000_000, False)]
    t = spark.createDataFrame(rows, "n int, day string, input_tokens bigint, output_tokens bigint, cache_write_tokens bigint, cache_read_tokens bigint, batch boolean")
    t = t.withColumn("cost_usd", cost({"input": 1.0, "output": 5.0, "cache_write": 1.25, "cache_read": 0.1}, F.col("batch")))
    assert [r.cost_usd for r in t.orderBy("n").collect()] == [6.0, 3.0, 0.1]
    assert [r.refused for r in guard(t, 9.0, ["n"], "day").orderBy("n").collect()] == [False, False, True]


def test_documents_from_files_and_back(spark, tmp_path):
    (tmp_path / "cb1-a.json").write_text('{"meeting": {"meeting_id": "a", "date": "2018-03-09"}, "votes": [{"motion_text": "m", "yes": 1, "no": 2}], "extraction_meta": {"input_tokens": 3}}')
    (tmp_path / "cb1-b.json").write_text("{broken")
    docs = readers.documents(spark, str(tmp_path), "cb1-*.json").withColumn("errors", schemas.errors())
    good = schemas.defaults(docs.filter("size(errors) = 0").drop("errors", "_corrupt_record"))
    t = loader.flatten(good)
    add = spark.createDataFrame([("a", "extra", 5), ("z", "no such meeting", 1)], "meeting_id string, motion_text string, yes int")
    t["votes"] = loader.override_votes(t["votes"], add, t["meetings"])
    loader.write_tables(t, str(tmp_path / "db"))
    v = spark.read.parquet(str(tmp_path / "db" / "votes.parquet")).orderBy("motion_text").collect()
    assert [(r.motion_text, r.yes, r.topic_category) for r in v] == [("extra", 5, None), ("m", 1, "other")]
    assert spark.read.parquet(str(tmp_path / "db" / "licenses.parquet")).count() == 0
    m = loader.finalize(good, spark.createDataFrame([("a", "2023-06-14", True)], "meeting_id string, date string, is_revised boolean")).select("meeting.date", "meeting.is_revised", "extraction_meta.warnings").first()
    assert m.date == "2023-06-14" and m.is_revised and len(m.warnings) == 1


def test_small_sources(spark, tmp_path):
    assert readers.ledger(spark, str(tmp_path / "none.jsonl")).count() == 0
    (tmp_path / "l.jsonl").write_text('{"ts": 1.0, "stage": "x", "cost_usd": 0.5}\n\n')
    assert readers.ledger(spark, str(tmp_path / "l.jsonl")).count() == 1
    (tmp_path / "h.txt").write_text("b\na\nc\n")
    assert [r.value for r in readers.lines(spark, str(tmp_path / "h.txt")).orderBy("ord").collect()] == ["b", "a", "c"]
    (tmp_path / "m.json").write_text('{"meetings": {"x": {"n": 1}, "y": {"n": 2}}}')
    assert {(r.key, r.value.n) for r in readers.json_map(spark, str(tmp_path / "m.json"), "STRUCT<n INT>", "meetings").collect()} == {("x", 1), ("y", 2)}
    n = readers.safe_names(spark.createDataFrame([(0, "a/My File.pdf"), (1, "b/my file.PDF")], "ord int, href string")).orderBy("ord").collect()
    assert n[0].local == "My_File.pdf" and n[1].local.endswith("-my_file.PDF")
    r = readers.fetch(spark, spark.createDataFrame([("ok",), ("bad",)], "u string"), "u", lambda u: b"x" if u == "ok" else 1 / 0).collect()
    assert {x.url: x.error is None for x in r} == {"ok": True, "bad": False}


def test_predictor_retries_once_and_isolates_failures(spark):
    items = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "boom")], "k int, p string")

    def make():
        def call(p):
            if p == "boom":
                raise ValueError("no")
            return "valid" if p == "good" or "not valid" in p else "junk"

        return call

    check = lambda a: a.withColumn("problem", F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("answer") != "valid", F.lit("junk")))
    r = {x.key: (x.answer, x.attempt) for x in predict.with_retry(items, "k", "p", make, check, lambda d: d.cache()).collect()}
    assert r == {"1": ("valid", 1), "2": ("valid", 2), "3": ("valid", 2)}
    assert predict.work_list(items, spark.createDataFrame([(1,)], "k int"), ["k"]).count() == 2


def test_fulltext(spark):
    t = spark.createDataFrame([("a", 2, "dog and DOG"), ("a", 1, "cat"), ("b", 1, None)], "g string, p int, t string")
    i = fulltext.index(t, "g", ["p"], "t")
    assert i.first().text == "cat dog and DOG"
    assert {(r.term, r.n) for r in fulltext.mentions(i, ["dog", "it's"]).collect()} == {("dog", 2), ("it's", 0)}
    k = fulltext.context(t, "g", "t", "dog", width=4, most=5).orderBy("k").collect()
    assert [x.context for x in k] == ["dog and", "and DOG"]


def test_first_uploads_drops_copies(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"ts": 10.0, "stage": "x", "meeting": "a"}\n{"ts": 12.0, "stage": "x", "meeting": "a"}\n{"ts": 13.0, "stage": "x", "meeting": "b"}\n')
    s = stream.first_uploads(stream.ledger_stream(spark, str(tmp_path / "in")), "meeting", "at")
    stream.run_once(s, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_column_helpers(spark):
    r = spark.createDataFrame([("Mr.  Dr. Jane   Roe", None)], "n string, z string").select(
        C.strip_honorifics(F.col("n")).alias("a"), C.match_key(F.col("n"), F.col("z")).alias("b"), C.right_closed_bins(F.lit(2019), [2015, 2019, 2022], ["x", "y"]).alias("c"), C.division(F.lit(0), F.lit(0), F.lit(0)).alias("d"), C.absolute_url(F.lit("/a b.pdf"), "https://h").alias("e")
    ).first()
    assert tuple(r) == ("Jane Roe", "mr dr jane roe none", "x", None, "https://h/a%20b.pdf")


def test_report_lists_and_gates(spark):
    cols = "meeting_id string, vote_id int, motion_text string, topic_category string, outcome string, yes int, no int, abstain int, recusal int"
    gold = [("a", 1, "repair the pier before winter", "parks", "passed", 9, 4, 0, 2), ("a", 2, "thank the staff", "other", "passed", 15, 0, 0, 0), ("b", 3, "move the stage", "parks", "failed", 6, 8, 1, 0)]
    found = [("a", 7, "repair of the pier before the winter", "parks", "passed", 9, 4, 0, 1), ("a", 8, "buy a boat", "other", "passed", 1, 0, 0, 0), ("b", 9, "move the stage", None, "failed", 6, 8, 1, 0)]
    g, f = spark.createDataFrame(gold, cols), spark.createDataFrame(found, cols)
    a, b = evaluate.side(g, "votes", "vote_id", "gi"), evaluate.side(f, "votes", "vote_id", "ei")
    m = evaluate.greedy(evaluate.candidates(a, b, ["meeting_id", "entity"]), ["meeting_id", "entity"])
    cards = {r.meeting_id: r for r in evaluate.report(a, b, m).collect()}
    assert (cards["a"].golden, cards["a"].extracted, cards["a"].matched, cards["a"].recall) == (2, 2, 1, 0.5)
    assert cards["a"].missed == ["thank the staff"] and cards["a"].spurious == ["buy a boat"] and cards["a"].field_errors == ["votes[1].recusal: golden=2 extracted=1"]
    assert cards["b"].field_accuracy == 5 / 6 and cards["b"].missed == []
    total = evaluate.roll_up(evaluate.report(a, b, m)).collect()
    tally = evaluate.tally_gate(g, f, m).first()
    assert abs(total[0].recall - 2 / 3) < 1e-9 and not total[0].passed and (tally.total, tally.exact, tally.passed) == (2, 1, False)
    assert evaluate.exit_code(total, tally) == 1 and evaluate.exit_code([], tally) == 2 and "FAILED: votes recall 67%; tallies 1 of 2" in evaluate.render(total, tally)
    same = evaluate.greedy(evaluate.candidates(a, a.withColumnRenamed("gi", "ei"), ["meeting_id", "entity"]), ["meeting_id", "entity"])
    assert evaluate.exit_code(evaluate.roll_up(evaluate.report(a, a.withColumnRenamed("gi", "ei"), same)).collect(), evaluate.tally_gate(g, g, same).first()) == 0


def test_report_matches_once(spark):
    """The matches serve the counts, the fields and two lists, and are computed once."""
    cols = "meeting_id string, vote_id int, motion_text string, topic_category string, outcome string, yes int, no int, abstain int, recusal int"
    t = spark.createDataFrame([("a", i, x, "parks", "passed", 9, 4, 0, 2) for i, x in enumerate(("repair the pier", "thank the staff", "buy a boat"))], cols)
    a, b = evaluate.side(t, "votes", "vote_id", "gi"), evaluate.side(t, "votes", "vote_id", "ei")
    rows = spark.sparkContext.accumulator(0)

    def told(batches):
        for x in batches:
            rows.add(len(x))
            yield x

    m = spark.createDataFrame([("a", "votes", i, i, 100.0) for i in range(2)], "meeting_id string, entity string, gi int, ei int, score double")
    r = evaluate.report(a, b, m.mapInPandas(told, m.schema)).first()
    assert (r.golden, r.matched, r.missed, r.spurious, r.field_accuracy, rows.value) == (3, 2, ["buy a boat"], ["buy a boat"], 1.0, 2)


def test_report_reads_each_side_twice(spark):
    """Once for the compared fields, once for the count and the list of those without a match; a meeting on one side only and an unknown one are told too."""
    cols = "meeting_id string, vote_id int, motion_text string, topic_category string, outcome string, yes int, no int, abstain int, recusal int"
    row = lambda m, i, x: (m, i, x, "parks", "passed", 9, 4, 0, 2)
    t = spark.createDataFrame([row("a", 1, "repair the pier"), row("a", 2, "thank the staff"), row("b", 3, "buy a boat"), row(None, 4, "move the stage")], cols)
    rows = spark.sparkContext.accumulator(0)

    def told(batches):
        for x in batches:
            rows.add(len(x))
            yield x

    gold = evaluate.side(t.mapInPandas(told, t.schema), "votes", "vote_id", "gi")
    found = evaluate.side(t.filter("vote_id < 3"), "votes", "vote_id", "ei")
    m = spark.createDataFrame([("a", "votes", 1, 1, 100.0)], "meeting_id string, entity string, gi int, ei int, score double")
    got = {r.meeting_id: (r.golden, r.extracted, r.matched, r.missed, r.spurious, r.field_accuracy) for r in evaluate.report(gold, found, m).collect()}
    assert got == {"a": (2, 2, 1, ["thank the staff"], ["thank the staff"], 1.0), "b": (1, 0, 0, ["buy a boat"], [], 1.0), None: (1, 0, 0, ["move the stage"], [], 1.0)}
    assert rows.value <= 8


def test_checkpoint_folder_where_none_is_set():
    """One machine may use a folder of its own; a cluster must name a shared one."""
    from types import SimpleNamespace as S

    from gavel.session import checkpoint_dir

    def session(master, told):
        sc = S(master=master, _jsc=S(sc=lambda: S(getCheckpointDir=lambda: S(isDefined=lambda: False))), getConf=lambda: S(get=lambda k, d: None), setCheckpointDir=told.append)
        return S(sparkContext=sc, conf=S(get=lambda k, d: None))

    told = []
    assert checkpoint_dir(session("local[2]", told)) == told[0]
    for master in ("yarn", "spark://x:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(session(master, told))


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    """Three runs: the first moves the watermark on, a row of a closed window comes too late in the second, the third closes the rest."""
    from gavel.streaming import ledger as L

    schema = "at timestamp, kind string, value double"
    for rows in ([("2024-01-01 10:00:00", "a", 1.0), ("2024-01-01 12:30:00", "a", 2.0)], [("2024-01-01 10:05:00", "a", 50.0), ("2024-01-01 12:40:00", "a", 3.0)], [("2024-01-02 00:00:00", "z", 0.0)]):
        spark.createDataFrame(rows, "at string, kind string, value double").selectExpr("CAST(at AS timestamp) AS at", "kind", "value").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        s = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        L.run_once(L.windowed(s, "at", ["kind"]), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted((str(r.window.start), r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect() if r.kind == "a")
    assert got == [("2024-01-01 10:00:00", 1, 1.0), ("2024-01-01 12:00:00", 2, 5.0)]
