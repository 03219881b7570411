"""Checks of id-list files: one row per finding, counted by grouped queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import decode_id


def validate(lists: DataFrame, ids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """lists: id, ids (comma-joined); ids: id, every id that is required; known: id, all candidates' ids.

    (finding, n): ids listed twice, required ones missing and others extra; within lists repeated ids,
    the record itself, ids that are of neither other source, and ids that do not exist (only if known).
    """
    x = lists.select("id", F.filter(F.transform(F.split("ids", ","), lambda t: F.trim(t)), lambda t: t != "").alias("l"))
    per_id = x.groupBy("id").agg(
        F.count("*").alias("rows"),
        F.sum((F.size("l") > F.size(F.array_distinct("l"))).cast("long")).alias("duplicate_in_list"),
        F.sum(F.size(F.filter("l", lambda c: c == F.col("id"))).cast("long")).alias("self_match"),
        F.sum(F.size(F.filter("l", lambda c: ~c.rlike("^S[23]-"))).cast("long")).alias("bad_prefix"),
    )
    # The file is read once for all that its rows and the required ids tell.
    both = per_id.join(ids.select("id", F.lit(True).alias("wanted")).distinct(), "id", "full")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("duplicate_in_list", "self_match", "bad_prefix")]
    counts = both.agg(F.count_if(F.col("rows") > 1).alias("duplicate_row"), *sums, F.count_if(F.col("rows").isNull()).alias("missing"), F.count_if(F.col("wanted").isNull()).alias("extra"))
    found = counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("finding"), F.col(c).alias("n")) for c in counts.columns))).alias("x")).select("x.finding", "x.n")
    if known is None:
        return found
    strays = x.select(F.explode("l").alias("c")).join(known.select(F.col("id").alias("c")).distinct(), "c", "left_anti")
    return found.unionByName(strays.agg(F.count("*").alias("n")).select(F.lit("unknown_id").alias("finding"), "n"))


def not_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of matches (id, ids) with ids that their candidate list does not hold: id, strays."""

    def parts(c: str):
        return F.filter(F.transform(F.split(c, ","), lambda t: F.trim(t)), lambda t: t != "")

    both = matches.join(candidates.select("id", F.col("ids").alias("cand")), "id", "left")
    return both.select("id", F.array_except(parts("ids"), F.coalesce(parts("cand"), F.array().cast("array<string>"))).alias("strays")).where(F.size("strays") > 0)


def same_order(lists: DataFrame, ids: DataFrame) -> DataFrame:
    """Positions (pos) at which the file's id is not the required one."""
    return lists.select("pos", "id").join(ids.select("pos", F.col("id").alias("wanted")), "pos", "full").where(~F.col("id").eqNullSafe(F.col("wanted")))


def written_ids(chosen: DataFrame) -> DataFrame:
    """chosen: i, ids (long) to text rows: id, ids."""
    text = F.array_join(F.transform("ids", decode_id), ",")
    return chosen.select(decode_id(F.col("i")).alias("id"), text.alias("ids"))
