"""Profiles of sources and truth: missing values, uniqueness, match patterns, look-alikes, evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens

#: Bits of exact evidence between two records.
EVIDENCE = {"same_raw_name": 1, "same_core": 2, "same_addr": 4, "same_nums": 8, "same_first_token": 16}


def missing(records: DataFrame, columns=("name_raw", "addr_raw", "name_core", "addr_n", "addr_nums")) -> DataFrame:
    return records.groupBy("src", "country").agg(F.count("*").alias("n"), *(F.round(F.avg((F.col(c) == "").cast("double")), 6).alias(c) for c in columns))


def uniqueness(records: DataFrame, column: str = "name_core") -> DataFrame:
    """Per source: values, the share of rows whose value is unique there, groups of ten and more."""
    g = records.groupBy("src", column).agg(F.count("*").alias("n"))
    return g.groupBy("src").agg(F.count("*").alias("n_values"), F.round(F.sum(F.when(F.col("n") == 1, 1).otherwise(0)) / F.sum("n"), 6).alias("unique_share"), F.count_if(F.col("n") >= 10).alias("groups_10"))


def match_pattern(ids: DataFrame, truth: DataFrame) -> DataFrame:
    """Records by the sources they match, and the histogram of their number of matches up to 3."""
    n = truth.groupBy("i").agg(F.count_if(F.col("src") == 2).alias("n2"), F.count_if(F.col("src") == 3).alias("n3"))
    d = ids.join(n, "i", "left").na.fill(0, ["n2", "n3"])
    pattern = F.when((F.col("n2") > 0) & (F.col("n3") > 0), "both").when(F.col("n2") > 0, "s2").when(F.col("n3") > 0, "s3").otherwise("none")
    return d.groupBy("country", pattern.alias("pattern"), F.least(F.col("n2") + F.col("n3"), F.lit(3)).alias("matches")).agg(F.count("*").alias("n"))


def orphans(records: DataFrame, truth: DataFrame) -> DataFrame:
    """Per source 2 and 3: rows, rows without an owner, rows with several, most owners."""
    owners = truth.groupBy("j").agg(F.count_distinct("i").alias("owners"))
    d = records.where("src in (2, 3)").select("src", F.col("eid").alias("j")).join(owners, "j", "left").na.fill(0, ["owners"])
    return d.groupBy("src").agg(F.count("*").alias("n"), F.count_if(F.col("owners") == 0).alias("orphans"), F.count_if(F.col("owners") > 1).alias("shared"), F.max("owners").alias("most"))


def look_alikes(records: DataFrame, truth: DataFrame, largest: int = 50) -> DataFrame:
    """Per country, source 1 records with a candidate of the same core name that is no match, among
    names that at most `largest` records of sources 2 and 3 have."""
    b = records.where("src in (2, 3)").select("country", "name_core", F.col("eid").alias("j"))
    small = b.groupBy("country", "name_core").agg(F.count("*").alias("n")).where(F.col("n") <= largest).drop("n")
    a = records.where("src = 1").select("country", "name_core", F.col("eid").alias("i"))
    pairs = a.join(b.join(small, ["country", "name_core"]), ["country", "name_core"]).join(truth.select("i", "j"), ["i", "j"], "left_anti")
    return pairs.groupBy("country").agg(F.count("*").alias("pairs"), F.count_distinct("i").alias("records"))


def evidence_bits(p: DataFrame) -> Column:
    """Packed evidence of a pair with the columns of both records."""
    first = F.get(tokens(F.col("name_core")), F.lit(0)) == F.get(tokens(F.col("name_core_b")), F.lit(0))
    tests = {"same_raw_name": F.col("name_raw") == F.col("name_raw_b"), "same_core": F.col("name_core") == F.col("name_core_b"), "same_addr": (F.col("addr_n") == F.col("addr_n_b")) & (F.col("addr_n") != ""), "same_nums": (F.col("addr_nums") == F.col("addr_nums_b")) & (F.col("addr_nums") != ""), "same_first_token": F.coalesce(first, F.lit(False))}
    bits = F.lit(0)
    for k, test in tests.items():
        bits = bits.bitwiseOR(F.when(test, EVIDENCE[k]).otherwise(0))
    return bits


def evidence(records: DataFrame, truth: DataFrame) -> DataFrame:
    """Of all true pairs, by country and source: the share with each kind of exact evidence, and with none."""
    columns = ["name_raw", "name_core", "addr_n", "addr_nums"]
    a = records.where("src = 1").select(F.col("eid").alias("i"), "country", *columns)
    b = records.where("src in (2, 3)").select(F.col("eid").alias("j"), *(F.col(c).alias(f"{c}_b") for c in columns))
    d = truth.select("i", "j", "src").join(a, "i").join(b, "j").withColumn("bits", evidence_bits(truth))
    shares = [F.round(F.avg((F.col("bits").bitwiseAND(F.lit(v)) > 0).cast("double")), 6).alias(k) for k, v in EVIDENCE.items()]
    return d.groupBy("country", "src").agg(F.count("*").alias("n"), *shares, F.round(F.avg((F.col("bits") == 0).cast("double")), 6).alias("no_evidence"))


def substitutions(pairs: DataFrame, a: str, b: str, top: int = 40) -> DataFrame:
    """Pairs whose texts differ in one token each: which is put for which, most frequent first."""
    ta, tb = F.array_distinct(tokens(F.col(a))), F.array_distinct(tokens(F.col(b)))
    d = pairs.select(F.array_except(ta, tb).alias("x"), F.array_except(tb, ta).alias("y")).where("size(x) = 1 and size(y) = 1")
    return d.groupBy(F.col("x")[0].alias("from_token"), F.col("y")[0].alias("to_token")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "from_token", "to_token").limit(top)


def weighted_quantiles(d: DataFrame, group: str, value: str, weight: str, at=(0.1, 0.5, 0.9)) -> DataFrame:
    """The least value at which the running weight reaches each share of the group's total."""
    g = d.groupBy(group, value).agg(F.sum(weight).alias("w"))
    run = F.sum("w").over(Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    g = g.withColumns({"run": run, "all": F.sum("w").over(Window.partitionBy(group))})
    cuts = [F.min(F.when(F.col("run") >= q * F.col("all") - 1e-9, F.col(value))).alias(f"q{round(q * 100)}") for q in at]
    return g.groupBy(group).agg(*cuts, F.round(F.sum(F.col("w") * F.col(value)) / F.sum("w"), 6).alias("mean"))


def corroboration(records: DataFrame, truth: DataFrame) -> DataFrame:
    """Records matched in both sources: how often the two matches agree on name and address between themselves."""
    b = records.select(F.col("eid").alias("j"), "name_core", "addr_n")
    t = truth.select("i", "j", "src").join(b, "j")
    two, three = t.where("src = 2"), t.where("src = 3").select("i", F.col("name_core").alias("n3"), F.col("addr_n").alias("a3"))
    d = two.join(three, "i")
    return d.agg(F.count("*").alias("triples"), F.round(F.avg((F.col("name_core") == F.col("n3")).cast("double")), 6).alias("same_name"), F.round(F.avg((F.col("addr_n") == F.col("a3")).cast("double")), 6).alias("same_addr"))


def prediction_stats(ids: DataFrame, chosen: DataFrame) -> DataFrame:
    """Per country: records, share with any match, mean and 95th percentile of matches (of a record's own
    number, the nearest), and source 3's share of the matches."""
    n = chosen.groupBy("i").agg(F.count("*").alias("n"), F.count_if(F.col("src") == 3).alias("n3"))
    d = ids.join(n, "i", "left").na.fill(0, ["n", "n3"])
    # Few numbers of matches are distinct, so only those are put in order.
    sizes = d.groupBy("country", "n").agg(F.count("*").alias("c"), F.sum("n3").alias("n3"))
    by = Window.partitionBy("country")
    reached = F.sum("c").over(by.orderBy("n")) > F.round(0.95 * (F.sum("c").over(by) - 1))
    g = sizes.withColumn("reached", reached).groupBy("country")
    total = F.sum(F.col("n") * F.col("c"))
    return g.agg(F.sum("c").alias("records"), F.round(F.sum(F.when(F.col("n") > 0, F.col("c")).otherwise(0)) / F.sum("c"), 6).alias("matched_share"), F.round(total / F.sum("c"), 6).alias("mean_matches"), F.min(F.when(F.col("reached"), F.col("n"))).alias("p95"), F.round(F.sum("n3") / F.greatest(total, F.lit(1)), 6).alias("s3_share"))
