"""Deterministic folds and samples: every draw is by an md5 rank that any engine reproduces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stable_rank


def buckets(ids: DataFrame, truth: DataFrame) -> DataFrame:
    """ids: i, country. Adds bucket: the number of matches, 3 at most."""
    n = truth.groupBy("i").agg(F.count("*").alias("n"))
    return ids.join(n, "i", "left").withColumn("bucket", F.least(F.coalesce("n", F.lit(0)), F.lit(3)).cast("int")).drop("n")


def _order(seed: int) -> list:
    return [stable_rank(F.col("i"), seed), F.col("i")]


def folds(strata: DataFrame, k: int, seed: int) -> DataFrame:
    """Round robin over each (country, bucket) in md5 order."""
    place = F.row_number().over(Window.partitionBy("country", "bucket").orderBy(*_order(seed)))
    return strata.withColumn("fold", ((place - 1) % k).cast("int"))


def leave_one_country_out(strata: DataFrame) -> DataFrame:
    """(i, held_out): each record is held out in its own country's turn."""
    return strata.select("i", F.col("country").alias("held_out"))


def in_sample(seed: int, one_in: int) -> Column:
    """About one in so many, by the md5 rank's leading hex digits against a bound."""
    return stable_rank(F.col("i"), seed) < f"{16**12 // one_in:012x}"


def lockbox(strata: DataFrame, exclude: DataFrame, share: float, seed: int) -> DataFrame:
    """Of each stratum without the excluded ids the first round(size * share) in md5 order."""
    pool = strata.join(exclude.select("i"), "i", "left_anti")
    w = Window.partitionBy("country", "bucket")
    pool = pool.withColumns({"pos": F.row_number().over(w.orderBy(*_order(seed))) - 1, "size": F.count("*").over(w)})
    return pool.where(F.col("pos") < F.round(F.col("size") * share)).select("i", "country", "bucket")


def train_sample(ids: DataFrame, forced: DataFrame, exclude: DataFrame, n: int, seed: int) -> DataFrame:
    """All forced ids and, in md5 order, enough of the others for n; none of the excluded."""
    pool = ids.join(exclude.select("i"), "i", "left_anti")
    kept = forced.select("i").join(exclude.select("i"), "i", "left_anti")
    rest = pool.join(kept, "i", "left_anti").select("i", F.lit(1).alias("late"))
    union = kept.select("i", F.lit(0).alias("late")).unionByName(rest)
    return union.orderBy("late", *_order(seed)).limit(n).select("i")


def band_sample(scores: DataFrame, low: float, high: float, easy_pos: int, easy_neg: int, seed: int) -> DataFrame:
    """scores: i, j, p, y. Every pair in the uncertain band and so many easy true and false ones."""
    tie = [F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("i").cast("string"), F.col("j").cast("string")).cast("binary")), 1, 12), F.col("i"), F.col("j")]
    hard = scores.where(F.col("p").between(low, high)).withColumn("part", F.lit("hard"))
    easy = scores.where(~F.col("p").between(low, high))
    pos = easy.where("y = 1").orderBy(*tie).limit(easy_pos).withColumn("part", F.lit("easy_pos"))
    neg = easy.where("y = 0").orderBy(*tie).limit(easy_neg).withColumn("part", F.lit("easy_neg"))
    return hard.unionByName(pos).unionByName(neg)


def stratified_weights(pairs: DataFrame, strata: list[str], size: int, floor: int, seed: int) -> DataFrame:
    """A sample of about `size` pairs with a floor per stratum, and weights that undo the floors."""
    tie = [F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("i").cast("string"), F.col("j").cast("string")).cast("binary")), 1, 12), F.col("i"), F.col("j")]
    total = pairs.agg(F.count("*").alias("total"))
    w = Window.partitionBy(*strata)
    d = pairs.withColumns({"n": F.count("*").over(w), "r": F.row_number().over(w.orderBy(*tie))}).crossJoin(F.broadcast(total))
    take = F.least("n", F.greatest(F.round(F.lit(size) * F.col("n") / F.col("total")), F.lit(floor)))
    return d.withColumn("take", take).where(F.col("r") <= F.col("take")).select("i", "j", *strata, F.round(F.col("n") / F.col("take"), 6).alias("weight"))


def mix(strata: DataFrame) -> DataFrame:
    """Share of each (country, bucket) in all rows."""
    g = strata.groupBy("country", "bucket").agg(F.count("*").alias("n"))
    return g.select("country", "bucket", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4).alias("share"))
