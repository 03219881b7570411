"""Records to normalized records, and the older multi-view normalization."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import RULES, canonical, clean, fold, joined, script, squeeze, tokens, transliterate, without

RECORD = ["eid", "src", "country", "name_raw", "addr_raw", "script", "name_n", "name_core", "name_alias", "name_web", "addr_n", "addr_nums"]


def normalize(records: DataFrame, rules: str = "n2", any_script: bool = False) -> DataFrame:
    """records: eid, src, country, name_raw, addr_raw. The normalized record of each (see RECORD).

    One projection without a shuffle. Null names, addresses and countries are ''. any_script spells
    scripts beyond Latin through an Arrow UDF.
    """
    version = RULES[rules]
    d = records.select("eid", "src", F.trim(F.coalesce("country", F.lit(""))).alias("country"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("name_raw", "addr_raw")))
    d = d.withColumn("script", script(F.col("name_raw"))).withColumn("n", F.lower(transliterate(F.col("name_raw"), any_script))).withColumn("a", F.lower(transliterate(F.col("addr_raw"), any_script)))

    d = d.withColumn("n", clean(clean(clean(F.col("n"), r"\(id:[^)]*\)"), r"\bm/s\b"), fixed.ALIAS, " | "))
    d = d.withColumn("web", F.nullif(F.regexp_extract(F.trim("n"), fixed.WEB, 1), F.lit("")))
    n = clean(clean(F.coalesce("web", "n"), "[&+]", " and "), "['.]", "")
    d = d.withColumn("n", clean(clean(n, "[^a-z0-9|]+"), "^[ |]+|[ |]+$", ""))
    names = dict(version.names)
    d = d.withColumn("name_n", canonical(F.replace("n", F.lit("|"), F.lit(" ")), names)).withColumn("alias", canonical(F.trim(F.coalesce(F.get(F.split("n", "[|]"), F.lit(1)), F.lit(""))), names))
    d = d.withColumn("core", without(F.col("name_n"), version.drop))
    d = d.withColumn("name_core", F.when(F.col("core") == "", F.col("name_n")).otherwise(F.col("core"))).withColumn("name_alias", without(F.col("alias"), version.drop))
    d = d.withColumn("name_web", F.col("web").isNotNull().cast("int"))

    a = clean(clean(F.col("a"), fixed.NULL_WORDS), r"(\d+)(?:st|nd|rd|th)\b", "$1")
    a = clean(clean(clean(a, r"(\d)([a-z])", "$1 $2"), r"([a-z])(\d)", "$1 $2"), "&", " and ")
    d = d.withColumn("a", F.trim(clean(a, "[^a-z0-9]+")))
    numbers = F.transform(F.regexp_extract_all("a", F.lit(r"\d+"), F.lit(0)), lambda x: F.coalesce(F.nullif(clean(x, "^0+", ""), F.lit("")), F.lit("0")))
    d = d.withColumn("addr_n", canonical(F.col("a"), dict(version.addresses))).withColumn("addr_nums", joined(F.array_sort(F.array_distinct(numbers))))
    return d.select(RECORD)


def name_views(d: DataFrame, name: str = "name_raw") -> DataFrame:
    """Six views of a name: all tokens, core, legal forms, sorted, acronym, compact."""
    base = fold(F.col(name))
    for pattern, to in fixed.VIEW_PHRASES:
        base = clean(base, pattern, to)
    legal = sorted(set(fixed.VIEW_LEGAL.values()))
    d = d.withColumn("t_", tokens(canonical(squeeze(base), fixed.VIEW_LEGAL)))
    rest = F.filter("t_", lambda t: ~t.isin(*legal))
    d = d.withColumn("c_", F.when(F.size(rest) > 0, rest).otherwise(F.col("t_")))
    plain = F.filter("c_", lambda t: ~t.isin(*fixed.VIEW_STOP))
    d = d.withColumn("p_", F.when(F.size(plain) > 0, plain).otherwise(F.col("c_")))
    return d.withColumns(
        {
            "name_norm": joined(F.col("t_")),
            "name_core": joined(F.col("c_")),
            "name_legal": joined(F.array_sort(F.array_distinct(F.filter("t_", lambda t: t.isin(*legal))))),
            "name_sorted": joined(F.array_sort(F.array_distinct("p_"))),
            "name_acronym": F.array_join(F.transform("p_", lambda t: F.substring(t, 1, 1)), ""),
            "name_compact": F.array_join("c_", ""),
        }
    ).drop("t_", "c_", "p_")


def address_views(d: DataFrame, address: str = "addr_raw") -> DataFrame:
    """Seven views of an address: tokens, sorted, digits, postal code, first number, landmark, count."""
    base = fold(F.col(address))
    d = d.withColumn("b_", base).withColumn("t_", tokens(canonical(F.col("b_"), fixed.VIEW_ADDRESS)))
    digits = F.regexp_extract_all("b_", F.lit(r"\d+"), F.lit(0))
    postal = F.filter(digits, lambda x: F.length(x).between(4, 6))
    return d.withColumns(
        {
            "addr_norm": joined(F.col("t_")),
            "addr_sorted": joined(F.array_sort(F.array_distinct("t_"))),
            "addr_digits": joined(digits),
            "addr_postal": F.coalesce(F.try_element_at(postal, F.lit(-1)), F.lit("")),
            "addr_first_num": F.coalesce(F.get(digits, F.lit(0)), F.lit("")),
            "addr_landmark": F.exists("t_", lambda t: t.isin(*fixed.LANDMARKS)).cast("int"),
            "addr_ntok": F.size("t_"),
        }
    ).drop("b_", "t_")


def normalize_frame(d: DataFrame) -> DataFrame:
    """All thirteen older views and the folded country."""
    return address_views(name_views(d)).withColumn("country_norm", fold(F.col("country")))
