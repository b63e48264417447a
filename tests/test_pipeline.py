import json
import re

from pyspark.sql import functions as F

from gavel.functions import dialect, display
from gavel.operators import predict
from gavel.plans import pipeline


def test_files_to_tables(spark):
    dense = "The motion was seconded by the committee chairperson and the minutes were read. "
    files = [(0, "d/minutes-part-1.pdf", "a"), (1, "d/minutes-20190704-part-1.pdf", "b"), (2, "d/minutes-20190704-part-2.pdf", "c"), (3, "d/zzz.pdf", "e"), (4, "d/special-2019-x.pdf", "f")]
    pages = [("a", 1, ""), ("b", 1, "BOARD MEETING July 4, 2019. " + dense * 12), ("b", 2, "Dear sir, sincerely"), ("c", 1, dense * 12), ("f", 1, "Special meeting, October 2, 2019. " + dense * 12), ("e", 1, "nothing")]
    f = spark.createDataFrame(files, "ord int, href string, sha256 string")
    p = spark.createDataFrame(pages, "sha256 string, page_no int, text string")
    ids = pipeline.identify(f, p, spark.createDataFrame([("zzz.pdf", "2020-01-01")], "filename string, date string"), prefix="m")
    got = {r.filename: (r.meeting_id, r.source) for r in ids.collect()}
    assert got["minutes-20190704-part-1.pdf"] == ("m-2019-07-04", "content") and got["minutes-20190704-part-2.pdf"] == ("m-2019-07-04", "filename")
    assert got["zzz.pdf"] == ("m-2020-01-01", "override") and got["special-2019-x.pdf"] == ("m-2019-10-02", "content")
    labelled = pipeline.segment(p, spark.createDataFrame([("a", 1, dense * 12)], "sha256 string, page_no int, scan_text string"))
    assert {(r.sha256, r.page_no): r.label for r in labelled.collect()}[("a", 1)] == "body"
    body = pipeline.bodies(ids, labelled)
    assert {r.meeting_id: r.pages for r in body.collect()} == {"m-2019-07-04": 2, "m-2019-10-02": 1}

    def make():
        def call(prompt):
            day = "2019-07-04" if "July 4, 2019" in prompt else "2019-10-02"
            if "October" in prompt and "not valid" not in prompt:
                return "sorry"
            return "```json\n" + json.dumps({"meeting": {"meeting_id": "x", "date": day}, "votes": [{"motion_text": "m", "yes": 3, "no": 1, "abstain": 0, "recusal": 0, "outcome": "passed"}]}) + "\n```"

        return call

    docs = pipeline.extract(body, spark.createDataFrame([], "meeting_id string"), make, lambda d: d.cache())
    assert {r.meeting_id: r.attempt for r in docs.collect()} == {"m-2019-07-04": 1, "m-2019-10-02": 2}
    m = pipeline.manifest(ids)
    assert {r.meeting_id: r.files for r in m.collect()}["m-2019-07-04"] == ["minutes-20190704-part-1.pdf", "minutes-20190704-part-2.pdf"]
    one = docs.withColumn("meeting", F.col("meeting").withField("meeting_id", F.col("meeting_id")))
    t = pipeline.load(one, m, spark.createDataFrame([("m-2019-07-04", "added", 9)], "meeting_id string, motion_text string, yes int"))
    assert sorted((r.meeting_id, r.motion_text, r.yes) for r in t["votes"].collect()) == [("m-2019-07-04", "added", 9), ("m-2019-07-04", "m", 3), ("m-2019-10-02", "m", 3)]
    assert t["meetings"].count() == 2


def test_long_bodies_are_read_whole(spark):
    """Every page of a body over the limit reaches the predictor, and a meeting comes out once, with the records of all its parts."""
    pages = [f"[page {i}]\nMotion {i}. " + "word " * (1 + 37 * i % 60) + "\n\n" for i in range(30)]
    long = "".join(pages) + "[page 30]\n" + "y" * 700 + " Motion 99. "
    for most in (90, 400, 5000, 10**6):
        cut = predict.parts(long, most)
        assert "".join(cut) == long and max(map(len, cut)) <= most
    assert all(p.startswith("[page ") for p in predict.parts("".join(pages), 400))
    assert predict.parts("") == [""]

    def make():
        def call(prompt):
            if prompt.startswith("Part 2/") and "m-2021-01-05" in prompt and "not valid" not in prompt or "m-2022-03-03" in prompt and "Motion 12." in prompt:
                return "sorry"
            day = re.search(r"\d{4}-\d\d-\d\d", prompt).group()
            votes = [{"motion_text": m, "yes": 1, "no": 0, "abstain": 0, "recusal": 0} for m in re.findall(r"Motion \d+", prompt)]
            doc = {"meeting": {"meeting_id": "x", "date": day}, "votes": votes, "extraction_meta": {"input_tokens": len(prompt), "warnings": ["w"]}}
            if prompt.startswith("Part 3/"):
                doc["meeting"]["chair"] = "Lee"
                del doc["votes"]
            return json.dumps(doc)

        return call

    body = spark.createDataFrame([("m-2021-01-05", "".join(pages)), ("m-2021-02-02", "2021-02-02 Motion 7."), ("m-2022-03-03", "".join(pages)), ("m-2020-01-01", "".join(pages))], "meeting_id string, body string")
    done = spark.createDataFrame([("m-2020-01-01",)], "meeting_id string")
    docs = {r.meeting_id: r for r in pipeline.extract(body, done, make, lambda d: d.cache(), most=1200).collect()}
    assert set(docs) == {"m-2021-01-05", "m-2021-02-02"}  # the third has a part that stays invalid
    cut = predict.parts("".join(pages), 1200)
    r = docs["m-2021-01-05"]
    assert [v.motion_text for v in r.votes] == [m for k, p in enumerate(cut) if k != 2 for m in re.findall(r"Motion \d+", p)] and len(cut) > 3
    assert r.attempt == 2 and r.meeting.chair == "Lee" and r.meeting.meeting_type == "combined" and r.liquor_licenses == []
    assert r.extraction_meta.warnings == ["w"] * len(cut) + [f"body read in {len(cut)} parts"] and r.extraction_meta.input_tokens > sum(map(len, cut))
    assert docs["m-2021-02-02"].extraction_meta.warnings == ["w"] and docs["m-2021-02-02"].attempt == 1


def test_escalation(spark):
    s = spark.createDataFrame([("a", 1, "one two"), ("a", 2, "w " * 30), ("a", 3, None)], "sha256 string, page_no int, scan_text string")
    every, few = pipeline.escalate(s)
    assert every.count() == 3 and {r.page_no for r in few.collect()} == {1, 3}


def test_dialect_and_display(spark):
    dialect.register(spark)
    r = spark.sql("SELECT regexp_matches('abc', 'b.') AS a, list_len(array('x')) AS b, days_between(DATE'2020-01-05', DATE'2020-01-01') AS c, safe_ratio(1, 0) AS d, list_contains_text(array('Live DJ'), 'dj') AS e, strftime_month(DATE'2020-03-01') AS f").first()
    assert tuple(r) == (True, 1, 4, None, True, "Mar 2020")
    d = spark.range(1).select(display.shortened(F.lit("x" * 70)).alias("a"), display.percent(F.lit(0.256)).alias("b"), display.tally(F.lit(1), F.lit(2), F.lit(0)).alias("c"), display.summary(F.lit(None).cast("string"), F.lit(" "), F.lit("yes")).alias("d"), display.words(F.lit("a_b")).alias("e")).first()
    assert tuple(d) == ("x" * 60 + "...", "26%", "1-2-0", "yes", "a b")
