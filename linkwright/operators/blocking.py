"""Multi-key blocking: eleven key families, capped postings weighted by rarity, best candidates per record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PHONETIC_STOP, skeleton, tokens

#: Family: (score group, cap on a key's records in sources 2 and 3). The order gives each its tie salt.
FAMILIES = {"N1": ("name", 300), "N2": ("name", 300), "N3": ("name", 300), "A1": ("addr", 200), "A2": ("addr", 200), "M1": ("mix", 200), "P1": ("name", 300), "P2": ("name", 300), "A3": ("addr", 200), "A4": ("addr", 200), "PN": ("mix", 200)}


@dataclass(frozen=True)
class Blocking:
    """rare_*: rarest tokens of a record that make keys; numbers, house_numbers, all_addr: numbers and
    address tokens used; top: candidates kept per family; total, side: by overall and by group rank.
    cap: overrides the families' own."""

    rare_name: int = 4
    rare_addr: int = 4
    numbers: int = 3
    house_numbers: int = 2
    all_addr: int = 16
    top: int = 25
    total: int = 40
    side: int = 10
    cap: int | None = None


def token_table(records: DataFrame) -> DataFrame:
    """(eid, src, country, kind, t): the distinct tokens of a record's name, address and phonetic name."""
    name = tokens(F.concat_ws(" ", "name_core", "name_alias"))
    addr = F.filter(tokens(F.col("addr_n")), lambda t: t.rlike("^[a-z][a-z0-9]{2,}$"))
    sound = F.filter(F.transform(F.filter(name, lambda t: t.rlike("^[a-z]{3,}$")), skeleton), lambda t: (F.length(t) >= 3) & ~t.isin(*PHONETIC_STOP))

    def of(kind: str, a: Column) -> Column:
        return F.transform(F.array_distinct(a), lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("t")))

    kinds = [of("name", name), of("addr", addr), of("phon", sound)]
    return records.select("eid", "src", "country", F.explode(F.concat(*kinds)).alias("x")).select("eid", "src", "country", "x.*")


def token_frequency(records: DataFrame) -> DataFrame:
    """(country, kind, t, f): in how many records of all sources a token is."""
    return token_table(records).groupBy("country", "kind", "t").agg(F.count("*").alias("f"))


def _pairs(a: Column, b: Column, family: str, ordered: bool = False) -> Column:
    """family|x|y of every x of a and y of b; of one list with itself only x < y."""
    each = F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.when(x < y, F.concat_ws("|", F.lit(family), x, y)) if ordered else F.concat_ws("|", F.lit(family), x, y))))
    return F.filter(each, lambda k: k.isNotNull()) if ordered else each


def record_keys(records: DataFrame, config: Blocking = Blocking()) -> DataFrame:
    """(eid, src, country, fam, key): the distinct keys of each record, all families in one explode.

    Rare tokens are the least frequent in the country, ties by the token itself.
    """
    found = token_table(records)
    # Well packed files make these look small enough to broadcast, which is the driver's memory: all tokens, all postings.
    ranked = found.hint("merge").join(found.groupBy("country", "kind", "t").agg(F.count("*").alias("f")), ["country", "kind", "t"])
    lists = ranked.groupBy("eid").agg(*(F.collect_list(F.when(F.col("kind") == k, F.struct("f", "t"))).alias(k) for k in ("name", "addr", "phon")))

    def rarest(kind: str, n: int) -> Column:
        return F.slice(F.transform(F.array_sort(F.coalesce(F.col(kind), F.array())), lambda x: x["t"]), 1, n)

    addr_all = F.slice(F.array_distinct(F.filter(tokens(F.col("addr_n")), lambda t: t.rlike("^[a-z][a-z0-9]{2,}$"))), 1, config.all_addr)
    by_length = F.transform(F.array_sort(F.transform(tokens(F.col("addr_nums")), lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t")))), lambda x: x["t"])
    d = records.join(lists.hint("merge"), "eid", "left").select("eid", "src", "country", rarest("name", config.rare_name).alias("name"), rarest("addr", config.rare_addr).alias("addr"), rarest("phon", config.rare_name).alias("phon"), F.slice(by_length, 1, config.numbers).alias("num"), addr_all.alias("addr_all"), F.replace("name_core", F.lit(" "), F.lit("")).alias("comp"))

    def one(a: Column, family: str) -> Column:
        return F.transform(a, lambda t: F.concat_ws("|", F.lit(family), t))

    name, addr, phon, num = (F.col(c) for c in ("name", "addr", "phon", "num"))
    house = F.slice(num, 1, config.house_numbers)
    families = {
        "N1": one(F.concat(name, F.filter(F.array("comp"), lambda t: t != "")), "N1"),
        "N2": _pairs(name, name, "N2", True),
        "N3": one(F.transform(F.filter(name, lambda t: F.length(t) >= 5), lambda t: F.substring(t, 1, 4)), "N3"),
        "A1": _pairs(num, addr, "A1"),
        "A2": _pairs(addr, addr, "A2", True),
        "M1": _pairs(F.slice(name, 1, 3), F.slice(addr, 1, 2), "M1"),
        "P1": one(phon, "P1"),
        "P2": _pairs(phon, phon, "P2", True),
        "A3": _pairs(num, num, "A3", True),
        "A4": _pairs(house, F.col("addr_all"), "A4"),
        "PN": _pairs(phon, house, "PN"),
    }
    keys = d.select("eid", "src", "country", F.explode(F.array_distinct(F.concat(*families.values()))).alias("key"))
    return keys.select("eid", "src", "country", F.substring("key", 1, 2).alias("fam"), "key")


def _caps(config: Blocking) -> Column:
    cap = F.lit(None)
    for fam, (_, n) in FAMILIES.items():
        cap = F.when(F.col("fam") == fam, config.cap if config.cap is not None else n).otherwise(cap)
    return cap


def _group() -> Column:
    out = F.lit("mix")
    for fam, (group, _) in FAMILIES.items():
        out = F.when(F.col("fam") == fam, group).otherwise(out)
    return out


def postings(keys: DataFrame, records: DataFrame, config: Blocking = Blocking()) -> DataFrame:
    """(country, fam, key, j, w): source 2 and 3 records of each key within its cap, weighted by
    ln N - ln df. Keys over the cap are dropped before anything is joined, which bounds each key's pairs."""
    total = records.where("src in (2, 3)").groupBy("country").agg(F.count("*").alias("n"))
    side = keys.where("src in (2, 3)")
    counts = side.groupBy("country", "fam", "key").agg(F.count("*").alias("df")).where(F.col("df") <= _caps(config))
    weighted = counts.join(total, "country").withColumn("w", rounded(F.log("n") - F.log("df"), 9)).select("country", "fam", "key", "w")
    return side.hint("merge").join(weighted, ["country", "fam", "key"]).select("country", "fam", "key", F.col("eid").alias("j"), "w")


def det_rank(score: str, salt: Column) -> Column:
    """Rank within i, ties by a salted md5 of both ids and then j: the same on any engine."""
    tie = F.md5(F.concat_ws("|", F.col("i").cast("string"), F.col("j").cast("string"), salt.cast("string")).cast("binary"))
    return F.row_number().over(Window.partitionBy("i").orderBy(F.desc(score), tie, "j"))


def rounded(x: Column, digits: int) -> Column:
    """x rounded as SQL engines do on doubles: scaled, halves away from zero, scaled back. Spark's round goes by
    the shortest decimal of x instead, and differs at halves, which sums of nine digits do hit."""
    return F.round(x * 10.0**digits) / 10.0**digits


def summed(w: str) -> Column:
    """The sum of a group's doubles as doubles add, least first: as SQL's for two. Exact sums round otherwise at halves;
    SQL's order of three or more is open, the one here is fixed."""
    return F.aggregate(F.array_sort(F.collect_list(w)), F.lit(0.0), lambda s, x: s + x)


def family_hits(keys: DataFrame, records: DataFrame, config: Blocking = Blocking()) -> DataFrame:
    """(i, j, fam, w): per source 1 record and family the best `top` records by the weight they share."""
    asking = keys.where("src = 1").select("country", "fam", "key", F.col("eid").alias("i"))
    hits = asking.hint("merge").join(postings(keys, records, config), ["country", "fam", "key"]).groupBy("i", "j", "fam").agg(rounded(summed("w"), 6).alias("w"))
    salt = F.lit(0)
    for k, fam in enumerate(FAMILIES, 1):
        salt = F.when(F.col("fam") == fam, k).otherwise(salt)
    tie = F.md5(F.concat_ws("|", F.col("i").cast("string"), F.col("j").cast("string"), salt.cast("string")).cast("binary"))
    rank = F.row_number().over(Window.partitionBy("i", "fam").orderBy(F.desc("w"), tie, "j"))
    return hits.withColumn("r", rank).where(F.col("r") <= config.top)


def candidates(records: DataFrame, config: Blocking = Blocking(), keys: DataFrame | None = None) -> DataFrame:
    """Candidate pairs of each source 1 record: i, j, s_name, s_addr, s_mix, n_fam, s_all and three ranks.
    keys: record_keys of the records where they are already written."""
    keys = record_keys(records, config) if keys is None else keys
    hits = family_hits(keys, records, config).withColumn("g", _group())
    scores = hits.groupBy("i", "j").agg(*(F.round(F.coalesce(F.sum(F.when(F.col("g") == g, F.col("w"))), F.lit(0.0)), 6).alias(f"s_{g}") for g in ("name", "addr", "mix")), F.count("*").alias("n_fam"))
    scores = scores.withColumn("s_all", F.round(F.col("s_name") + F.col("s_addr") + F.col("s_mix"), 6))
    ranked = scores.withColumns({f"r_{g}": det_rank(f"s_{g}", F.lit(0)) for g in ("all", "name", "addr")})
    keep = (F.col("r_all") <= config.total) | ((F.col("r_name") <= config.side) & (F.col("s_name") > 0)) | ((F.col("r_addr") <= config.side) & (F.col("s_addr") > 0))
    return ranked.where(keep)
