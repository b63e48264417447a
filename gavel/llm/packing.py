"""Documents packed into containers of fixed capacity, by bulk-synchronous rounds of best fit.

Sizes are tokens of a public tokenizer. A text larger than the capacity is cut into full pieces and a rest; nothing
else is divided. All capacities are packed at once. As many containers are open as the unplaced tokens need; each round

1. takes the largest unplaced documents that hold about half of the open room (all of them once rooms are of the size of
   documents) and range-sorts them by size; neighbours are bundled up to `FILL` of a typical room, so a container takes few
   bundles, not many small texts, and the smallest documents stay for the last gaps;
2. range-sorts bundles and gaps together and sweeps every partition from the largest down: a bundle claims the tightest
   gap that still holds it, its successor; of bundles that claim one gap the one of the higher rank gets it, the next
   takes the next tightest;
3. exchanges what is left at the borders: bundles without a gap in their partition claim, by rank, the tightest free
   gaps of the partitions above, told by the counts of each partition;
4. places what was matched, updates the gaps and closes those smaller than any document. Losers try again.

Rounds go on until everything is placed. Every round places the smallest document at least, and rooms halve from round
to round while there are bundles, so their number grows with the logarithm of capacity over document size, not with
the number of documents.

Scale: every step is a range partitioning, a pass over sorted partitions or an equi-join; each round's results are
written to the shared checkpoint folder. A few numbers a capacity (counts, sums, the size from which documents take part)
reach the driver, never a document, a container or a size histogram. Hot sizes are no hot keys: ties are spread by id.

Defined cases: null, empty and blank texts have size 0 and go to the first container of their capacity; rows with a
null id are left out; one id in several rows counts as several documents of that id with their rows' sizes; ties are
broken by id; an empty table gives an empty result; capacities that are null or below 1 are skipped; any number of
capacities is packed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the tokenizer splits a text into the words within which it merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Share of a typical gap that a bundle may fill.
FILL = 0.6
#: Tables made by the driver are broadcast up to so many rows.
SMALL = 100_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens): the size of every text. tokenizer: a file of ranks, read on the executors by path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = _tokenizer(tokenizer)
        for b in batches:
            size = {x: len(t.encode_ordinary(x)) if x and x.strip() else 0 for x in set(b["t"])}
            yield pd.DataFrame({"doc_id": b["i"], "tokens": b["t"].map(size).astype("int64")})

    return docs.select(F.col(id_col).cast("bigint").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).filter("i IS NOT NULL").mapInPandas(run, "doc_id bigint, tokens bigint")


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """A frame of nullable integers; ids keep all their bits."""
    return pd.DataFrame({c: pd.array(x, dtype="Int64") for c, x in zip(names, zip(*rows) if rows else [[]] * len(names))})


def bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Neighbours of a sorted partition in bundles up to their target; the first row of a bundle carries its total."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    number, held, total, of = 0, [], 0, None
    cols = ["size_id", "key", "doc_id", "piece", "tokens", "bundle", "total"]

    def close(out: list) -> None:
        nonlocal number, held, total
        for k, r in enumerate(held):
            out.append((*r, part << 40 | number, total if k == 0 else None))
        number, held, total = number + 1, [], 0

    for b in batches:
        out: list = []
        for c, key, doc, piece, n, target in zip(*(b[x].tolist() for x in ("size_id", "key", "doc_id", "piece", "tokens", "target"))):
            if held and (c != of or total + n > target):
                close(out)
            held.append((c, key, doc, piece, n))
            total, of = total + n, c
        yield _frame(out, cols)
    out = []
    close(out)
    yield _frame(out, cols)


def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A sorted partition of gaps and bundles, largest first, gaps before bundles of their size: every bundle takes the
    tightest free gap before it. What is left is ranked: bundles from the largest, gaps from the tightest, by capacity."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    cols = ["size_id", "bundle", "gap", "part", "rank"]
    free: list[int] = []
    losers, of = 0, None

    def rest() -> list:
        return [(of, None, g, part, k) for k, g in enumerate(reversed(free))]

    for b in batches:
        out = []
        for c, is_bundle, i in zip(b["size_id"].tolist(), b["is_bundle"].tolist(), b["id"].tolist()):
            if c != of:
                out += rest()
                free, losers, of = [], 0, c
            if not is_bundle:
                free.append(i)
            elif free:
                out.append((c, i, free.pop(), part, None))
            else:
                out.append((c, i, None, part, losers))
                losers += 1
        yield _frame(out, cols)
    yield _frame(rest(), cols)


def exchange(counts: pd.DataFrame) -> pd.DataFrame:
    """Segments (size_id, part, from_rank, n, gap_part, gap_rank) from the counts of left bundles and gaps of each partition
    of one capacity: bundles take the free gaps of the nearest partition above, tightest first."""
    free: list[list[int]] = []
    out = []
    for c, part, left, gaps in counts.sort_values("part")[["size_id", "part", "bundles", "gaps"]].itertuples(index=False):
        at = 0
        while at < left and free:
            of, first, n = free[-1]
            m = min(left - at, n)
            out.append((c, part, at, m, of, first))
            at += m
            free[-1] = [of, first + m, n - m]
            if n == m:
                free.pop()
        if gaps:
            free.append([part, 0, gaps])
    return pd.DataFrame(out, columns=["size_id", "part", "from_rank", "n", "gap_part", "gap_rank"])


def _small(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A table made by the driver, broadcast only up to `SMALL` rows."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= SMALL else df


def _opened(spark, fresh: list[tuple[int, int, int, int]]) -> DataFrame:
    """(size_id, container_id, room) of newly opened containers (size_id, capacity, first number, how many)."""
    runs = spark.createDataFrame(fresh, "size_id bigint, room bigint, a bigint, n bigint")
    runs = runs.withColumn("b", F.explode(F.expr("sequence(0, (n - 1) DIV 50000)"))).repartition("size_id", "b")
    each = F.explode(F.expr("sequence(a + b * 50000, a + least(n, (b + 1) * 50000) - 1)"))
    return runs.withColumn("k", each).select("size_id", F.xxhash64(F.lit("open"), "size_id", "k").alias("container_id"), "room")


def matched(bundled: DataFrame, gaps: DataFrame) -> DataFrame:
    """(size_id, bundle, gap): one round's matching of bundles to gaps that hold them, one bundle a gap."""
    heads = bundled.filter("total IS NOT NULL").select("size_id", F.col("total").alias("v"), F.lit(True).alias("is_bundle"), F.col("bundle").alias("id"))
    both = heads.unionByName(gaps.select("size_id", F.col("room").alias("v"), F.lit(False).alias("is_bundle"), F.col("container_id").alias("id")))
    by = ["size_id", F.desc("v"), "is_bundle", "id"]
    swept = cut(both.repartitionByRange(*by).sortWithinPartitions(*by).mapInPandas(sweep, "size_id bigint, bundle bigint, gap bigint, part bigint, rank bigint"))
    left = swept.filter("rank IS NOT NULL")
    counts = left.groupBy("size_id", "part").agg(F.count("bundle").alias("bundles"), F.count("gap").alias("gaps"))
    segments = counts.groupBy("size_id").applyInPandas(exchange, "size_id bigint, part bigint, from_rank bigint, n bigint, gap_part bigint, gap_rank bigint")
    claims = left.filter("bundle IS NOT NULL").drop("gap").join(segments, ["size_id", "part"]).filter("rank >= from_rank AND rank < from_rank + n")
    claims = claims.select("size_id", "bundle", F.col("gap_part").alias("part"), (F.col("gap_rank") + F.col("rank") - F.col("from_rank")).alias("rank"))
    across = claims.join(left.filter("gap IS NOT NULL").drop("bundle"), ["size_id", "part", "rank"]).select("size_id", "bundle", "gap")
    return swept.filter("rank IS NULL").select("size_id", "bundle", "gap").unionByName(across)


def pack(sizes: DataFrame, capacities: DataFrame, report: list | None = None) -> DataFrame:
    """(size_id, container_id, doc_id, piece, tokens) for (doc_id, tokens) and (size_id, capacity_tokens).

    report: takes one row a round and capacity (round, size_id, unplaced documents, open gaps, target of the bundles).
    """
    spark = sizes.sparkSession
    caps = {r["size_id"]: r["c"] for r in capacities.filter("size_id IS NOT NULL AND capacity_tokens >= 1").groupBy("size_id").agg(F.max("capacity_tokens").cast("bigint").alias("c")).collect()}
    schema = "size_id bigint, container_id bigint, doc_id bigint, piece bigint, tokens bigint"
    if not caps:
        return spark.createDataFrame([], schema)
    rows = cut(sizes.select("doc_id", F.col("tokens").cast("bigint").alias("tokens")).filter("doc_id IS NOT NULL").withColumn("row", F.monotonically_increasing_id()))
    each = F.explode(F.array(*[F.struct(F.lit(c).cast("bigint").alias("size_id"), F.lit(n).cast("bigint").alias("cap")) for c, n in sorted(caps.items())]))
    all_docs = rows.withColumn("_c", each).select("doc_id", "tokens", "row", "_c.size_id", "_c.cap")
    # pieces of the capacity itself are full containers of their own
    big = all_docs.filter("tokens >= cap")
    full = big.select("size_id", "doc_id", "row", "cap", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("tokens DIV cap - 1"))).alias("piece"))
    placed = [full.select("size_id", F.xxhash64("size_id", "row", "piece").alias("container_id"), "doc_id", "piece", F.col("cap").alias("tokens"))]
    empty = all_docs.filter("tokens = 0").select("size_id", "doc_id", F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("tokens"))
    waiting = all_docs.filter("tokens % cap <> 0").select("size_id", F.xxhash64("size_id", "row").alias("key"), "doc_id", F.expr("tokens DIV cap").alias("piece"), F.expr("tokens % cap").alias("tokens"))
    waiting = cut(waiting)
    gaps = spark.createDataFrame([], "size_id bigint, container_id bigint, room bigint")
    opened, before, rounds = dict.fromkeys(caps, 0), {}, 0
    while True:
        none = F.lit(None).cast("double")
        mine = waiting.groupBy("size_id").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"), F.min("tokens").alias("low"), none.alias("sq"))
        theirs = gaps.groupBy("size_id").agg(F.count(F.lit(1)).alias("n"), F.sum("room").alias("t"), F.lit(None).cast("bigint").alias("low"), F.sum(F.col("room").cast("double") * F.col("room")).alias("sq"))
        stats = mine.unionByName(theirs).collect()
        left, open_ = ({r["size_id"]: r for r in stats if (r["sq"] is None) == w} for w in (True, False))
        if not left:
            break
        fresh, goal = [], []
        for c, r in left.items():
            n, room, sq = (open_[c]["n"], open_[c]["t"], open_[c]["sq"]) if c in open_ else (0, 0, 0.0)
            more = max(0, -(-(r["t"] - room) // caps[c]))
            if more:
                fresh.append((c, caps[c], opened[c], more))
                opened[c] += more
            n, room, sq = n + more, room + more * caps[c], sq + float(more) * caps[c] ** 2
            # the room of a gap as the open room sees it: many nearly full containers do not count for much
            target = int(FILL * sq / room)
            # all take part, each on its own, where rooms are of the size of documents, or nothing was placed before
            if target * r["n"] < r["t"] or before.get(c) == r["n"]:
                target = 0
            goal.append((c, target, max(room // 2, 1) if target else r["t"] + 1, r["low"]))
            if report is not None:
                report.append((rounds, c, r["n"], n, target))
        before = {c: r["n"] for c, r in left.items()}
        rounds += 1
        if fresh:
            gaps = gaps.unionByName(_opened(spark, fresh))
        goals = _small(spark, goal, "size_id bigint, target bigint, share bigint, low bigint")
        gaps = gaps.join(goals, "size_id").filter("room >= low").select("size_id", "container_id", "room")
        # the size from which documents take part; the window runs over sizes, at most as many as the capacity
        sums = waiting.groupBy("size_id", "tokens").agg(F.sum("tokens").alias("t"))
        larger = F.coalesce(F.sum("t").over(W.partitionBy("size_id").orderBy(F.desc("tokens")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        least = sums.withColumn("larger", larger).join(goals, "size_id").filter("larger < share").groupBy("size_id").agg(F.min("tokens").alias("least"), F.max("target").alias("target"))
        least = _small(spark, [tuple(r) for r in least.collect()], "size_id bigint, least bigint, target bigint")
        known = waiting.join(least, "size_id")
        by = ["size_id", F.desc("tokens"), "key"]
        active = known.filter("tokens >= least").repartitionByRange(*by).sortWithinPartitions(*by)
        bundled = cut(active.mapInPandas(bundles, "size_id bigint, key bigint, doc_id bigint, piece bigint, tokens bigint, bundle bigint, total bigint"))
        met = matched(bundled, gaps)
        now = cut(bundled.join(met, ["size_id", "bundle"], "left").select("size_id", "key", "doc_id", "piece", "tokens", F.col("gap").alias("container_id")))
        done = now.filter("container_id IS NOT NULL")
        placed.append(done.select("size_id", "container_id", "doc_id", "piece", "tokens"))
        waiting = known.filter("tokens < least").select("size_id", "key", "doc_id", "piece", "tokens").unionByName(now.filter("container_id IS NULL").drop("container_id"))
        took = done.groupBy("size_id", "container_id").agg(F.sum("tokens").alias("took"))
        gaps = cut(gaps.join(took, ["size_id", "container_id"], "left").select("size_id", "container_id", (F.col("room") - F.coalesce("took", F.lit(0))).alias("room")).filter("room > 0"))
        if rounds % 4 == 0:
            waiting = cut(waiting)
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    first = out.groupBy("size_id").agg(F.min("container_id").alias("c"))
    out = out.unionByName(empty.join(first, "size_id", "left").select("size_id", F.coalesce("c", F.lit(0)).alias("container_id"), "doc_id", "piece", "tokens"))
    return out.select("size_id", "container_id", "doc_id", "piece", "tokens")
