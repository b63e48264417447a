"""Records that differ only in formatting: one row each, with the number of its copies.

Every (field label, normalised value) pair is hashed, the hashes of a record are added up (a commutative multiset
hash, so interchangeable fields need no sorting), records are grouped by block and fingerprint, and inside a group the
multisets of values are compared exactly. Two independent sums of 61 bits each make up the fingerprint; records that
share it by accident are split off and held against each other's values; no values are sorted anywhere.

Scale: the scan feeds a map-side-combined aggregation on 16 bytes a record; only groups of two and more are joined
back, and that join is one row to many, so a group with a third of all rows is split by the skew-join rule (the
aggregated side is one row a group). Nothing is collected.

Defined cases: null, blank and sign-only values are all the empty value; rows with a null block belong to no group;
rows repeated with the same id count once; an empty table gives an empty result; further columns are ignored by
`copies` and kept by `collapse`; texts of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: A Mersenne prime: sums of up to four residues stay below 2^63, and each step is reduced again.
MOD = (1 << 61) - 1


def bare(c: Column) -> Column:
    """Letters and digits only, one letter case; '' for null."""
    return F.coalesce(F.regexp_replace(F.lower(F.upper(c)), r"[^\p{L}\p{N}]", ""), F.lit(""))


def _sum_of_hashes(pairs: Column, salt: str) -> Column:
    return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda a, p: F.pmod(a + F.pmod(F.xxhash64(F.lit(salt), p["label"], p["value"]), F.lit(MOD)), F.lit(MOD)))


def _same(a: Column, b: Column) -> Column:
    """Equality of two multisets, without sorting."""
    return F.forall(a, lambda x: F.size(F.filter(a, lambda y: y == x)) == F.size(F.filter(b, lambda y: y == x)))


def _members(df: DataFrame, id_col: str, block: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """(id, first_id) of every record whose fingerprint occurs twice or more."""
    pairs = F.array(*[F.struct(F.lit(label).alias("label"), bare(F.col(c)).alias("value")) for c, label in fields.items()])
    base = (
        df.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_b{k}") for k, c in enumerate(block)], pairs.alias("_v"))
        .dropna(subset=["_id", *[f"_b{k}" for k in range(len(block))]])
        .withColumn("_f1", _sum_of_hashes(F.col("_v"), "a"))
        .withColumn("_f2", _sum_of_hashes(F.col("_v"), "b"))
    )
    key = [*[f"_b{k}" for k in range(len(block))], "_f1", "_f2"]
    first = (
        base.groupBy(*key)
        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.min_by("_v", "_id").alias("_fv"))
        .filter("_first < _last")
        .drop("_last")
    )
    # only members of groups are kept from here on
    met = cut(base.join(first, key).withColumn("_same", _same(F.col("_v"), F.col("_fv"))))
    good = met.filter("_same").select("_first", "_id").distinct()
    # other records of the same fingerprint: each goes to the least of the group's writings that is the same multiset
    odd = met.filter("NOT _same")
    writings = odd.groupBy(*key).agg(F.collect_set("_v").alias("_all"))
    odd = odd.join(writings, key).withColumn("_x", F.array_min(F.filter("_all", lambda w: _same(w, F.col("_v")))))
    rest = odd.join(odd.groupBy(*key, "_x").agg(F.min("_id").alias("_least")), [*key, "_x"]).select(F.col("_least").alias("_first"), "_id").distinct()
    return good.unionByName(rest).select(F.col("_id").alias("id"), F.col("_first").alias("first_id"))


def copies(df: DataFrame, id_col: str, block: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """(id, first_id, copies) of every record in a group of two or more.

    fields: column -> label. Columns with one label are interchangeable.
    """
    rows = _members(df, id_col, block, fields)
    n = rows.groupBy("first_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return rows.join(n, "first_id").select("id", "first_id", "copies")


def found(df: DataFrame, id_col: str, block: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """(first_id, copy_id): one row for each member of a group but its first."""
    return _members(df, id_col, block, fields).filter("id <> first_id").select("first_id", F.col("id").alias("copy_id"))


def collapse(df: DataFrame, id_col: str, block: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """The first record of every group and every single record, whole, with `copies` (of that name with a suffix if taken)."""
    c = copies(df, id_col, block, fields).select(F.col("id").alias("_cid"), F.col("first_id").alias("_cf"), F.col("copies").alias("_cn"))
    name = "copies" if "copies" not in df.columns else "copies_count"
    out = df.join(c, df[id_col] == c["_cid"], "left").filter("_cf IS NULL OR _cf = _cid")
    return out.withColumn(name, F.coalesce("_cn", F.lit(1).cast("bigint"))).drop("_cid", "_cf", "_cn")
