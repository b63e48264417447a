import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gavel.llm import crf, leakage, packing, pii, queries, residue

DATA = "/root/testdata/sf0.001"
TAGGER = crf.Tagger.load(pii.WEIGHTS.read_bytes())


def tagged(text):
    return {(k, text[a:b]) for k, a, b in pii.spans(TAGGER, [text])[0]}


@pytest.mark.parametrize(
    "text, want",
    [
        ("Please deliver the sofa to 14 Winder St. Apt. 3 before noon; the buyer is Oliver Hollenbeck.", {("name", "Oliver Hollenbeck"), ("address", "14 Winder St. Apt. 3")}),
        ("Questions? Write to g_hollenbeck@mailer.example or greta at mailer dot example.", {("email", "g_hollenbeck@mailer.example"), ("email", "greta at mailer dot example")}),
        ("The clerk copied SSN 912-44-1234 onto the form.", {("id_number", "912-44-1234")}),
        ("Ring (212) 555-0101 about the broken lift.", {("phone", "(212) 555-0101")}),
        ("12 percent of the members came at 7:30 on May 4, 2019.", set()),
        ("", set()), ("   ", set()),
    ],
)
def test_details(text, want):
    assert tagged(text) == want


def test_held_out_accuracy():
    """Frames that training never sees."""
    from gavel.llm import pii_train as T

    cases = T.held_out(500)
    assert not set(T.KEPT_OUT) & set(T.TRAINING)
    hit, found, total = ({k: 0 for k in crf.KINDS} for _ in range(3))
    for (t, g), s in zip(cases, pii.spans(TAGGER, [t for t, _ in cases])):
        f = {(k, t[a:b]) for k, a, b in s}
        for k in crf.KINDS:
            mine, theirs = {x for x in f if x[0] == k}, {x for x in g if x[0] == k}
            hit[k], found[k], total[k] = hit[k] + len(mine & theirs), found[k] + len(mine), total[k] + len(theirs)
    for k, least in (("email", 0.95), ("phone", 0.93), ("id_number", 0.93), ("address", 0.93), ("name", 0.75)):
        assert hit[k] / total[k] >= least and hit[k] / found[k] >= least, (k, hit[k], found[k], total[k])


def test_windows_agree_with_themselves_on_long_texts():
    one = "Write to abc@mailer.example, or call 212-555-0101, or come to 14 Winder Street, Apt 3. It rained all day. "
    spans = pii.spans(TAGGER, [one * 60])[0]
    assert [k for k, _, _ in spans] == ["email", "phone", "address"] * 60


def test_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in crf.init(5, 4, rng).items()}
    codes, tags, n = rng.integers(1, 20, (3, 6)), rng.integers(0, crf.N_TAGS, (3, 6)), np.array([6, 4, 2])
    for k in ("V", "T", "Uf", "Wb"):
        _, g = crf.fit_batch(p, codes, tags, n, 0.0, np.random.default_rng(1))
        i = (1, 2)
        e = 1e-3
        hi, lo = ({**p, k: p[k].copy()} for _ in range(2))
        hi[k][i] += e
        lo[k][i] -= e
        d = (crf.fit_batch(hi, codes, tags, n, 0.0, np.random.default_rng(1))[0] - crf.fit_batch(lo, codes, tags, n, 0.0, np.random.default_rng(1))[0]) / (2 * e)
        assert abs(d - g[k][i]) < 2e-3 * max(1, abs(d))


def test_details_and_redaction_in_tables(spark):
    rows = [(1, "Mr. Karl Winder complained of the broken lift.", "Ann Lee (family: 212-555-0101)", "k"), (1, "Mr. Karl Winder complained of the broken lift.", None, "k"), (2, None, "", None), (3, "The rent for 3 Oak St. is $900 a month and will not rise. " * 200, "child, age 9", "k")]
    t = spark.createDataFrame(rows, "id bigint, s string, v string, kind string")
    got = {tuple(r) for r in pii.details(t, "id", {"s": "t.s", "v": "t.v"}).collect()}
    assert {("t.s", 1, "name", "Karl Winder"), ("t.v", 1, "phone", "212-555-0101"), ("t.s", 3, "address", "3 Oak St")} <= got and all(r[1] != 2 for r in got)
    r = pii.redact(t, ["s", "v"]).orderBy("id", "v").collect()
    assert r[1].s == "Mr. [NAME] complained of the broken lift." and r[1].v == "[NAME] (family: [PHONE])" and r[2].s is None and r[2].v == "" and r[0].kind == "k"
    assert pii.details(t.limit(0), "id", {"s": "x"}).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_every_snippet_is_redacted(spark):
    """Each field that p1_found reads comes out of a query in all its rows, without the details found in it."""
    q = queries.queries()
    found = {}
    for r in q["p1_found"](spark, DATA).collect():
        found.setdefault((r.field, r.record_id), []).append(r.found)
    for name, t, key, cols in (("p1_redacted", "incidents", "incident_id", ("victim_name", "source_snippet")), ("p1_redacted_speakers", "speakers", "speaker_id", ("source_snippet",))):
        rows = q[name](spark, DATA).collect()
        raw = spark.read.parquet(f"{DATA}/{t}.parquet").select(key, *cols).collect()
        assert sorted(r[key] for r in rows) == sorted(r[key] for r in raw)
        changed = {r[key]: r for r in raw}
        for c in cols:
            assert any(k[0] == f"{t}.{c}" for k in found)
            for r in rows:
                want = changed[r[key]][c]
                for x in sorted(found.get((f"{t}.{c}", r[key]), []), key=len, reverse=True):
                    assert r[c] != want and r[c].count(x) < want.count(x)


def test_leaks(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("bdfgklmnprstv") + rnd.choice("aeiou") for _ in range(rnd.randrange(2, 5)))
    items = [(i, " ".join(word() for _ in range(60)) + ".") for i in range(6)] + [(8, None), (9, " ")]
    say = lambda i, a, b: " ".join(items[i][1].split()[a:b])
    filler = " ".join(word() for _ in range(300))
    dropped = say(2, 0, 40).split()
    del dropped[11], dropped[25]
    docs = [
        (1, filler + say(0, 0, 60).upper() + filler), (2, filler + say(1, 20, 46).replace(" ", "\n") + filler), (3, " ".join(dropped)), (4, say(3, 0, 30) + "\n\nPage 3 of 9\n\n" + say(3, 30, 60)),
        (5, filler + say(4, 0, 15) + filler), (6, filler), (7, None), (8, ""), (9, filler * 40 + say(5, 5, 58) + filler * 40), (1, filler + say(0, 0, 60).upper() + filler), (10, say(0, 0, 30)[:-1].replace("a", "a") + "-\n" + say(0, 30, 60)),
    ]
    d = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id bigint, text string, item_id int")
    it = spark.createDataFrame(items, "item_id bigint, text string")
    want = {(1, 0), (2, 1), (3, 2), (4, 3), (9, 5), (10, 0)}
    assert {(r.doc_id, r.item_id) for r in leakage.leaks(d, it).collect()} == want
    assert {(r.doc_id, r.item_id) for r in leakage.leaks(d, it, block_chars=400).collect()} == want  # items in several blocks
    assert leakage.leaks(d, it.limit(0)).count() == 0 and leakage.leaks(d.limit(0), it).count() == 0
    assert {(r.item_id, r.documents) for r in leakage.leaked_items(leakage.leaks(d, it)).collect()} == {(0, 2), (1, 1), (2, 1), (3, 1), (5, 1)}


def test_a_passage_of_many_items_leaks_each(spark):
    """A copy is found whether its text is one item's or several items', in one block or in many."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("bdfgklmnprstv") + rnd.choice("aeiou") for _ in range(rnd.randrange(2, 5)))
    shared = " ".join(word() for _ in range(60))
    own = [" ".join(word() for _ in range(30)) for _ in range(5)]
    items = [(i, shared) for i in range(3)] + [(3 + i, shared + " " + own[i]) for i in range(4)] + [(9, own[4] + " " + own[4][::-1])]
    docs = [(1, " ".join(word() for _ in range(200)) + " " + shared + " end"), (2, "before " + own[4]), (3, " ".join(word() for _ in range(200)))]
    d, it = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = {(1, i) for i in range(7)} | {(2, 9)}
    for chars in (4_000_000, 1000, 1):
        assert {(r.doc_id, r.item_id) for r in leakage.leaks(d, it, block_chars=chars).collect()} == want
    assert {(r.item_id, r.documents) for r in leakage.leaked_items(leakage.leaks(d, it)).collect()} == {(i, 1) for i in (*range(7), 9)}


def test_like_wording_is_no_leak():
    item = 2 * "In the Garden ballot, 431 papers were folded inside Harbor newspapers. Rust had eaten 12 rivets of the Willow gantry before Mason noticed."
    other = 2 * "In the Meadow ballot, 988 papers were folded inside Castle newspapers. Rust had eaten 77 rivets of the Poplar gantry before Carver noticed."
    assert leakage.Index([(1, item)], 0.4, 0.085).search([other, "x " + item]) == [{}, {1: 1.0}]


def test_equal_short_and_unspaced_items_leak(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("bdfgklmnprstv") + rnd.choice("aeiou") for _ in range(rnd.randrange(2, 5)))
    text, han = " ".join(word() for _ in range(70)), "这是一段只供测试使用的文字请不要把它放进训练材料里面谢谢各位编辑和读者的理解与支持我们明年再见"
    docs = [(1, " ".join(word() for _ in range(90)) + " " + text), (2, "he said: PARIS -- France, at last"), (3, "xabcdex abcd e"), (4, "so abcde it is"), (5, "昨天他们在会上说" + han[4:40] + "然后大家都回家了"), (6, "France, Paris")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    for copies in (1, 2, 3, 50):
        items = [(i, text) for i in range(copies)] + [(100, "Paris, France"), (101, "abcde"), (102, han), (103, "..."), (100, "Paris, France")]
        it = spark.createDataFrame(items, "item_id bigint, text string")
        want = {(1, i) for i in range(copies)} | {(2, 100), (4, 101), (5, 102)}
        for chars in (4_000_000, 60):
            assert {(r.doc_id, r.item_id) for r in leakage.leaks(d, it, block_chars=chars).collect()} == want


def test_vectorised_alignment_is_the_best_local_one():
    """Against the plain recurrence over all cells of the band."""
    rnd = np.random.default_rng(8)

    def plain(same):
        rows, width = same.shape
        best, state = (0.0, 0, 0), {}
        for i in range(rows):
            here = {}
            for b in range(width):
                s, m, st = state.get(b, (0.0, 0, i))
                cell = (s + 1, m + 1, -st) if same[i, b] else (s - 2, m, -st)
                for other in (state.get(b + 1), here.get(b - 1)):
                    if other:
                        cell = max(cell, (other[0] - 0.9, other[1], -other[2]))
                if cell[0] > 0.05:
                    here[b] = (cell[0], cell[1], -cell[2])
                    best = max(best, (round(cell[0], 6), cell[1], i + 1 + cell[2]))
            state = here
        return best[0], best[1]

    cases = [rnd.random((rnd.integers(1, 30), rnd.integers(1, 25))) < rnd.choice([0.1, 0.4]) for _ in range(60)]
    for c in cases[::2]:
        c[np.arange(len(c)), min(3, c.shape[1] - 1)] |= rnd.random(len(c)) < 0.8
    for c, (matched, spanned) in zip(cases, leakage.align(cases)):
        assert matched == plain(c)[1] and matched <= spanned <= len(c) or not c.any()


def test_a_round_matches_bundles_to_their_successors(spark):
    """Over many partitions: one bundle a gap, every gap large enough, and as many matches as any matching has."""
    rnd = random.Random(6)
    docs = [(c, 10_000 * c + k, rnd.choice([7, rnd.randrange(1, 60)])) for c in (1, 2) for k in range(150)]
    gaps = [(c, (1 << 60) + 10_000 * c + k, rnd.choice([7, rnd.randrange(1, 60)])) for c in (1, 2) for k in range(100)]
    b = spark.createDataFrame(docs, "size_id bigint, bundle bigint, total bigint")
    g = spark.createDataFrame(gaps, "size_id bigint, container_id bigint, room bigint")
    got = packing.matched(b, g).collect()
    size, room = {(c, i): n for c, i, n in docs}, {(c, i): n for c, i, n in gaps}
    assert len({(r.size_id, r.gap) for r in got}) == len({(r.size_id, r.bundle) for r in got}) == len(got)
    assert all(size[r.size_id, r.bundle] <= room[r.size_id, r.gap] for r in got)
    for c in (1, 2):
        free, n = [], 0
        for v, kind in sorted([(x, 0) for k, _, x in gaps if k == c] + [(x, 1) for k, _, x in docs if k == c], key=lambda x: (-x[0], x[1])):
            if kind == 0:
                free.append(v)
            elif free:
                free.pop()
                n += 1
        assert n == sum(r.size_id == c for r in got)


def test_bundles_keep_order_and_target():
    import pandas as pd

    rows = [(1, k, k, 0, n, 10) for k, n in enumerate([12, 9, 5, 4, 3, 3, 3, 1])] + [(2, 90, 90, 0, 1, 10)]
    out = pd.concat(packing.bundles(iter([pd.DataFrame(rows[:4], columns=["size_id", "key", "doc_id", "piece", "tokens", "target"]), pd.DataFrame(rows[4:], columns=["size_id", "key", "doc_id", "piece", "tokens", "target"])])))
    groups = [(g.tokens.tolist(), g.total.dropna().tolist()) for _, g in out.groupby("bundle", sort=False)]
    assert groups == [([12], [12]), ([9], [9]), ([5, 4], [9]), ([3, 3, 3, 1], [10]), ([1], [1])]


def test_many_capacities_settle(spark):
    caps = spark.createDataFrame([(i, 50 + i) for i in range(1200)], "size_id bigint, capacity_tokens bigint")
    r = packing.pack(spark.createDataFrame([(i, 9 + i) for i in range(12)], "doc_id bigint, tokens bigint"), caps)
    assert r.groupBy("size_id", "container_id").agg(F.sum("tokens").alias("t")).filter("t > 50 + size_id").count() == 0
    assert r.groupBy("size_id").agg(F.sum("tokens").alias("t")).filter("t = 174").count() == 1200


def test_pack(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randrange(0, 140)) for i in range(500)] + [(900 + i, 30) for i in range(300)] + [(2000, 1), (2000, 1), (None, 5), (3000, 1000), (3001, 100)]
    caps = spark.createDataFrame([(1, 100), (2, 333), (3, None), (4, 0)], "size_id bigint, capacity_tokens bigint")
    r = packing.pack(spark.createDataFrame(rows, "doc_id bigint, tokens bigint"), caps).collect()
    for c, cap in ((1, 100), (2, 333)):
        mine = [x for x in r if x.size_id == c]
        load = {}
        for x in mine:
            load[x.container_id] = load.get(x.container_id, 0) + x.tokens
        total = sum(n for i, n in rows if i is not None)
        assert sum(load.values()) == total and max(load.values()) <= cap and {x.doc_id for x in mine} == {i for i, _ in rows if i is not None}
        pieces = {}
        for x in mine:
            pieces.setdefault(x.doc_id, []).append(x)
        assert all(len(p) == 1 or i == 2000 or sum(x.tokens for x in p) > cap for i, p in pieces.items())
        assert len(load) <= -(-total // cap) * 1.05 + 2
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, tokens bigint"), caps).count() == 0


def test_token_counts(spark):
    t = spark.createDataFrame([(1, "Hello world"), (2, None), (3, " \n"), (4, "<|endoftext|>"), (None, "x")], "doc_id bigint, text string")
    n = {r.doc_id: r.tokens for r in packing.token_counts(t).collect()}
    assert n[1] == 2 and n[2] == 0 and n[3] == 0 and n[4] > 1 and len(n) == 4


CONTENT = ["The committee met at the library and heard a report on {} street lights. The vote was {} to 3.", "Minutes of the {} meeting were accepted with {} corrections. A member asked about the budget.", "Residents of {} Avenue asked for {} more bike racks near the school.", "A member said the site showed a 404 error {} times when he tried to comment, and {} people nodded.", "The notice began with 'Dear [OWNER NAME]', as {} pointed out {} times. [applause] The chair thanked all."]


@pytest.fixture(scope="module")
def documents():
    rnd = random.Random(3)
    good = [(i, "MEETING MINUTES\n" + " ".join(rnd.choice(CONTENT).format(rnd.choice(["Oak", "May", "Elm"]), rnd.randrange(90)) for _ in range(4))) for i in range(300)]
    bad = [(1000, "HTTP 404\nPage not found\nThe address /x on a.example does not exist."), (1001, "Home | Minutes | Contact\nPlease enable JavaScript to view this page."), (1002, "MEETING MINUTES\nLorem ipsum dolor sit amet consectetur adipiscing elit. Lorem ipsum dolor."),
        (1003, good[0][1] + " Please reply to {{ first_name }} before noon."), (1004, "blah blah blah blah blah blah"), (1005, "Held on [INSERT DATE HERE]. " + good[1][1]), (1006, "PLEASE ENABLE JAVASCRIPT TO VIEW THIS PAGE."), (1000, "HTTP 404\nPage not found\nThe address /x on a.example does not exist.")]
    return good, bad


def test_residue(spark, documents):
    good, bad = documents
    rows = [(i, t, "x") for i, t in good + bad] + [(2000, None, "x"), (2001, "", None), (2002, " \n", "x")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, verdict string")
    r = {(x.doc_id, x.verdict) for x in residue.residue(d).collect()}
    assert {i for i, _ in r} == {i for i, _ in bad}
    assert {i for i, v in r if v == "placeholder"} == {1003, 1005}
    assert residue.content_only(d).count() == len(good) + 3
    assert residue.residue(d.limit(0)).count() == 0


def test_long_placeholders(spark, documents):
    good, _ = documents
    long = ["[INSERT the full legal name and mailing address of the applicant HERE]", "{{ the name of the applicant as it is written in the articles of incorporation }}", "<<the name of the applicant as it is written in the articles of incorporation>>"]
    assert min(map(len, long)) > 62 and all([m.group() for m in residue._SLOT.finditer(f"Held by {x} in May.")] == [x] for x in long)
    m = residue.train(spark.createDataFrame(good, "doc_id bigint, text string"))
    assert [m.verdict(f"{good[2][1]} Held on May 2 by {x} in the library.") for x in long] == ["placeholder"] * 3
    assert not any(m.verdict(t) for _, t in good)


def test_copies_do_not_fill_the_sample(spark, documents):
    """A text in many rows counts once among the texts that the models are fitted on, wherever its hash lies; long texts are in it."""
    good, _ = documents
    d = spark.createDataFrame(good[:60], "doc_id bigint, text string")
    first = d.selectExpr("text", "xxhash64(text) AS h").orderBy("h").first().text
    d = d.unionByName(spark.createDataFrame([(i, first) for i in range(5000, 5100)] + [(9000, "long text " * 5000)], "doc_id bigint, text string"))
    rows = residue.sample(d, "text", 40, 1000).collect()
    assert len({r.h for r in rows}) == len(rows) == 40
    rows = residue.sample(d, "text", 10**6, 1000).collect()
    assert len(rows) == d.select("text").distinct().count() and max(len(r.t) for r in rows) == 1000


def test_placeholders_in_forms_that_no_list_names():
    m = residue.fit_models([], residue.TRUSTED, residue.TRUSTED_SLOTS)
    assert [x for x in ("$BUSINESS_NAME$", "__/__/____", "##city##", "%date%") if [y.group() for y in residue._SLOT.finditer(f"It was sent to {x} today.")] != [x]] == []
    assert m.verdict(None) is None and m.verdict(" ") is None
