"""How good candidates, scores and match sets are: recall, F0.5, calibration, errors and their shares."""

from __future__ import annotations

from functools import reduce
from math import comb, exp, sin

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .decide import blended
from .splits import in_sample


def blocking_recall(truth: DataFrame, cand: DataFrame, ids: DataFrame, cutoffs=(5, 10, 20, 40)) -> DataFrame:
    """truth: i, j, src; cand: i, j, r_all; ids: i, country. Rows (measure, slice, value): the share of true
    pairs that are candidates, overall, by source, by country and by rank, and of records with all of them."""
    t = truth.join(ids, "i").join(cand.select("i", "j", "r_all"), ["i", "j"], "left").withColumn("hit", F.col("r_all").isNotNull())
    share = F.round(F.avg(F.col("hit").cast("double")), 6).alias("value")
    entity = t.groupBy("i").agg(F.bool_and("hit").alias("hit"))
    parts = [
        t.agg(share).select(F.lit("pair").alias("measure"), F.lit("all").alias("slice"), "value"),
        t.groupBy("src").agg(share).select(F.lit("source"), F.col("src").cast("string"), "value"),
        t.groupBy("country").agg(share).select(F.lit("country"), "country", "value"),
        entity.agg(share).select(F.lit("entity"), F.lit("all"), "value"),
    ]
    at = t.agg(*(F.round(F.avg(F.coalesce(F.col("r_all") <= k, F.lit(False)).cast("double")), 6).alias(str(k)) for k in cutoffs))
    parts.append(at.select(F.explode(F.map_from_arrays(F.array(*(F.lit(str(k)) for k in cutoffs)), F.array(*(F.col(str(k)) for k in cutoffs)))).alias("slice", "value")).select(F.lit("rank"), "slice", "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def f_beta(tp: Column, n_pred: Column, n_true: Column) -> Column:
    """F0.5 of one record: 1 if nothing is true nor predicted, 0 if only one of them is empty."""
    return F.when((n_pred == 0) & (n_true == 0), 1.0).when((n_pred == 0) | (n_true == 0), 0.0).otherwise(1.25 * tp / (0.25 * n_true + n_pred))


def per_record(ids: DataFrame, chosen: DataFrame, truth: DataFrame) -> DataFrame:
    """ids: i, country; chosen: i, j; truth: i, j. Every id: n_true, n_pred, tp, f."""
    both = truth.select("i", "j", F.lit(1).alias("t")).join(chosen.select("i", "j", F.lit(1).alias("c")), ["i", "j"], "full")
    counts = both.groupBy("i").agg(F.count("t").alias("n_true"), F.count("c").alias("n_pred"), F.count_if(F.col("t").isNotNull() & F.col("c").isNotNull()).alias("tp"))
    out = ids.join(counts, "i", "left").na.fill(0, ["n_true", "n_pred", "tp"])
    return out.withColumn("f", f_beta(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def summary(records: DataFrame) -> DataFrame:
    """Of per_record's rows, for ALL and each country: macro F0.5 overall and for records without and with
    matches, micro precision and recall, and the shares of empty predictions and of records without matches."""

    def mean(x: Column) -> Column:
        return F.round(F.avg(x), 6)

    sets = records.groupingSets([["country"], []], "country")
    return sets.agg(
        F.count("*").alias("n"),
        mean(F.col("f")).alias("macro_f05"),
        mean(F.when(F.col("n_true") == 0, F.col("f"))).alias("singleton_f05"),
        mean(F.when(F.col("n_true") > 0, F.col("f"))).alias("multi_f05"),
        F.round(F.sum("tp") / F.greatest(F.sum("n_pred"), F.lit(1)), 6).alias("micro_p"),
        F.round(F.sum("tp") / F.greatest(F.sum("n_true"), F.lit(1)), 6).alias("micro_r"),
        mean((F.col("n_pred") == 0).cast("double")).alias("empty_share"),
        mean((F.col("n_true") == 0).cast("double")).alias("singleton_share"),
    ).withColumn("country", F.coalesce("country", F.lit("ALL")))


def oracle(ids: DataFrame, cand: DataFrame, truth: DataFrame) -> DataFrame:
    """Each record's F0.5 if every true candidate and nothing else were chosen."""
    return per_record(ids, truth.select("i", "j").join(cand.select("i", "j"), ["i", "j"], "left_semi"), truth)


def threshold_grid(spark, ids: DataFrame, scores: dict[str, DataFrame], truth: DataFrame, taus: list[float]) -> DataFrame:
    """Macro F0.5 of every score table (by name) at every threshold, overall: mode, tau, macro_f05, micro_p, micro_r.

    One pass: pairs are exploded to the thresholds they pass, and records that choose nothing at one are
    accounted for by their number.
    """
    low = min(taus)
    t = truth.select("i", "j", F.lit(1).alias("t"))
    n_true = truth.groupBy("i").agg(F.count("*").alias("n_true"))
    totals = ids.join(n_true, "i", "left").agg(F.count("*").alias("n"), F.count_if(F.col("n_true").isNull()).alias("singles"), F.sum("n_true").alias("all_true"))
    out = None
    for mode, table in scores.items():
        passed = table.where(F.col("p") >= low).join(t, ["i", "j"], "left")
        at = passed.select("i", F.explode(F.filter(F.array(*(F.lit(x) for x in taus)), lambda x: F.col("p") >= x)).alias("tau"), F.coalesce("t", F.lit(0)).alias("hit"))
        e = at.groupBy("tau", "i").agg(F.count("*").alias("n_pred"), F.sum("hit").alias("tp")).join(n_true, "i", "left").na.fill(0, ["n_true"])
        e = e.withColumn("f", f_beta(F.col("tp"), F.col("n_pred"), F.col("n_true")))
        g = e.groupBy("tau").agg(F.sum("f").alias("f"), F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"), F.count_if(F.col("n_true") == 0).alias("wrong"))
        every = spark.createDataFrame([(x,) for x in taus], "tau double").join(g, "tau", "left").na.fill(0)
        # A record without matches that chooses nothing scores 1.
        row = every.crossJoin(F.broadcast(totals)).select(F.lit(mode).alias("mode"), "tau", F.round((F.col("f") + F.col("singles") - F.col("wrong")) / F.col("n"), 6).alias("macro_f05"), F.round(F.col("tp") / F.greatest("n_pred", F.lit(1)), 6).alias("micro_p"), F.round(F.col("tp") / F.greatest("all_true", F.lit(1)), 6).alias("micro_r"))
        out = row if out is None else out.unionByName(row)
    return out


def threshold_sweep(spark, ids: DataFrame, scores: dict[str, DataFrame] | DataFrame, truth: DataFrame, taus: list[float], mix: dict[str, float] | None = None, modes: list[str] | None = None) -> DataFrame:
    """Macro F0.5 of every score table (by name; or one table with a column mode of these modes) at every threshold, of ALL records, of each country and, with
    mix, of the countries in these shares (MIX): mode, tau, slice, macro_f05, micro_p, micro_r."""
    n_true = truth.groupBy("i").agg(F.count("*").alias("n_true"))
    of_ids = ids.join(n_true, "i", "left").na.fill(0, ["n_true"])
    totals = of_ids.groupBy("country").agg(F.count("*").alias("n"), F.count_if(F.col("n_true") == 0).alias("singles"), F.sum("n_true").alias("true"))
    if isinstance(scores, dict):
        modes, scores = list(scores), reduce(DataFrame.unionByName, (t.select("i", "j", "p", F.lit(m).alias("mode")) for m, t in scores.items()))
    passed = scores.where(F.col("p") >= min(taus))
    passed = passed.join(truth.select("i", "j", F.lit(1).alias("hit")), ["i", "j"], "left").withColumn("tau", F.explode(F.filter(F.array(*map(F.lit, taus)), lambda x: F.col("p") >= x)))
    each = passed.groupBy("mode", "tau", "i").agg(F.count("*").alias("n_pred"), F.count("hit").alias("tp")).join(of_ids, "i")
    each = each.groupBy("mode", "tau", "country").agg(F.sum(f_beta(F.col("tp"), F.col("n_pred"), F.col("n_true"))).alias("f"), F.sum("tp").alias("tp"), F.sum("n_pred").alias("pred"), F.count_if(F.col("n_true") == 0).alias("wrong"))
    cells = spark.createDataFrame([(m, x) for m in modes for x in taus], "mode string, tau double").crossJoin(totals)
    cells = cells.join(each, ["mode", "tau", "country"], "left").na.fill(0)
    # A record without matches that chooses nothing scores 1.
    cells = cells.withColumn("f", F.col("f") + F.col("singles") - F.col("wrong"))
    slices = cells.groupingSets([["mode", "tau"], ["mode", "tau", "country"]], "mode", "tau", "country")
    micro = [F.round(F.sum("tp") / F.greatest(F.sum(c), F.lit(1)), 6).alias(f"micro_{x}") for x, c in (("p", "pred"), ("r", "true"))]
    out = slices.agg(F.round(F.sum("f") / F.sum("n"), 6).alias("macro_f05"), *micro).withColumn("slice", F.coalesce("country", F.lit("ALL")))
    out = out.select("mode", "tau", "slice", "macro_f05", "micro_p", "micro_r")
    if mix is None:
        return out
    share = F.element_at(F.create_map(*(F.lit(x) for c, w in mix.items() for x in (c, w / sum(mix.values())))), F.col("country"))
    mixed = cells.where(F.col("country").isin(*mix)).groupBy("mode", "tau").agg(F.round(F.sum(share * F.col("f") / F.col("n")), 6).alias("macro_f05"))
    none = F.lit(None).cast("double")
    return out.unionByName(mixed.select("mode", "tau", F.lit("MIX").alias("slice"), "macro_f05", none.alias("micro_p"), none.alias("micro_r")))


def cross_fitted_blend(spark, ids: DataFrame, scores: DataFrame, second: DataFrame, truth: DataFrame, weights: list[float], taus: list[float], seed: int) -> DataFrame:
    """The weight and threshold that are best on one half of the records, by an md5 draw, scored on the
    other: half (held out), w, tau, fitted (macro F0.5 on the other half), held_out, and alone, that of the
    best threshold of the first scores alone. Ties go to the larger weight, then to the smaller threshold."""
    halves = ids.select("i", F.when(in_sample(seed, 2), "a").otherwise("b").alias("country"))
    first = scores.select("i", "j", "p").join(second.select("i", "j", "ce"), ["i", "j"], "left")
    each = F.explode(F.array(*(F.struct(F.lit(str(w)).alias("mode"), F.round(blended(w), 6).alias("p")) for w in weights))).alias("x")
    grid = threshold_sweep(spark, halves, first.select("i", "j", each).select("i", "j", "x.p", "x.mode"), truth, taus, modes=list(map(str, weights))).where("slice <> 'ALL'").select(F.col("mode").cast("double").alias("w"), "tau", "slice", "macro_f05")
    # half is the one whose records were not fitted on.
    fitted = grid.select(F.when(F.col("slice") == "a", "b").otherwise("a").alias("half"), "w", "tau", F.col("macro_f05").alias("fitted"))
    scored = grid.select(F.col("slice").alias("half"), "w", "tau", F.col("macro_f05").alias("held_out"))
    both = fitted.join(scored, ["half", "w", "tau"])

    def best(d: DataFrame) -> DataFrame:
        order = F.struct(F.col("fitted").alias("f"), F.col("w").alias("x"), (-F.col("tau")).alias("y"), F.col("held_out").alias("h"))
        return d.groupBy("half").agg(F.max(order).alias("m")).select("half", F.col("m.x").alias("w"), (-F.col("m.y")).alias("tau"), F.col("m.f").alias("fitted"), F.col("m.h").alias("held_out"))

    return best(both).join(best(both.where("w = 1")).select("half", F.col("held_out").alias("alone")), "half")


def calibration_bins(scores: DataFrame, bins: int = 20) -> DataFrame:
    """scores: p, y. Of each bin: number, mean score, share of true pairs, and the bin's part of the expected error."""
    b = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).alias("bin")
    g = scores.groupBy(b).agg(F.count("*").alias("n"), F.avg("p").alias("mp"), F.avg(F.col("y").cast("double")).alias("my"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return g.select("bin", "n", F.round("mp", 6).alias("mean_p"), F.round("my", 6).alias("mean_y"), F.round(share * F.abs(F.col("mp") - F.col("my")), 6).alias("ece_part"))


#: Kinds of wrong pairs, fixed values: chosen wrongly for a record without or with matches; true pairs
#: that are just below the threshold, missed beside found ones, or scored low.
CHOSEN_WRONGLY, NOT_CHOSEN = ("singleton_fp", "multi_fp"), ("rejected", "missed_extra", "scored_low")


def label_errors(scores: DataFrame, truth: DataFrame, tau: float) -> DataFrame:
    """Every wrong pair at the threshold: i, j, p, cat, a name of CHOSEN_WRONGLY or NOT_CHOSEN."""
    marked = scores.select("i", "j", "p").join(truth.select("i", "j", F.lit(True).alias("true")), ["i", "j"], "left")
    pairs = marked.groupBy("i").agg(F.collect_list(F.struct("j", "p", F.col("true").isNotNull().alias("true"))).alias("pairs"))
    matched = truth.select("i", F.lit(True).alias("some")).distinct()
    wrong = F.filter("pairs", lambda x: x["true"] != (x["p"] >= tau))
    wrong = pairs.join(matched, "i", "left").select("i", F.explode(wrong).alias("x"), F.col("some").isNull().alias("none"), F.exists("pairs", lambda x: x["true"] & (x["p"] >= tau)).alias("found"))
    p = F.col("x.p")
    over = F.element_at(F.array(*map(F.lit, CHOSEN_WRONGLY)), F.when(F.col("none"), 1).otherwise(2))
    under = F.element_at(F.array(*map(F.lit, NOT_CHOSEN)), F.when(p >= 0.5, 1).otherwise(F.when(F.col("found"), 2).otherwise(3)))
    return wrong.select("i", "x.j", "x.p", F.when(p >= tau, over).otherwise(under).alias("cat"))


def f_sets(pred: set, truth: set) -> float:
    if not pred and not truth:
        return 1.0
    if not pred or not truth:
        return 0.0
    return 1.25 * len(pred & truth) / (0.25 * len(truth) + len(pred))


def shapley_losses(ids: DataFrame, scores: DataFrame, truth: DataFrame, tau: float) -> DataFrame:
    """(i, cat, loss): what each kind of a record's errors costs, its mean gain in F0.5 when mended over
    all orders of mending.

    Mending a kind only moves the record's three counts, so F0.5 with any set of kinds mended, a bit
    mask, is an expression of its counts; a kind's mean gain weighs each mask without it by the share
    of orders in which just those come before it. A kind that a record lacks gains nothing.
    """
    kinds = (*CHOSEN_WRONGLY, *NOT_CHOSEN)
    counts = label_errors(scores, truth, tau).groupBy("i").agg(*(F.count_if(F.col("cat") == k).alias(k) for k in kinds))
    d = per_record(ids, scores.where(F.col("p") >= tau).select("i", "j"), truth).join(counts, "i")

    def mended(mask: int) -> Column:
        more, less = (sum((F.col(k) for b, k in enumerate(kinds) if mask >> b & 1 and k in some), F.lit(0)) for some in (NOT_CHOSEN, CHOSEN_WRONGLY))
        return f_beta(F.col("tp") + more, F.col("n_pred") + more - less, F.col("n_true"))

    d = d.select("i", *kinds, *(mended(m).alias(f"f{m}") for m in range(1 << len(kinds))))

    def gain(b: int) -> Column:
        before = [m for m in range(1 << len(kinds)) if not m >> b & 1]
        return sum(((F.col(f"f{m | 1 << b}") - F.col(f"f{m}")) / (len(kinds) * comb(len(kinds) - 1, m.bit_count())) for m in before), F.lit(0.0))

    each = F.array(*(F.struct(F.lit(k).alias("cat"), F.col(k).alias("n"), gain(b).alias("loss")) for b, k in enumerate(kinds)))
    return d.select("i", F.explode(F.filter(each, lambda x: x["n"] > 0)).alias("x")).select("i", "x.cat", "x.loss")


def poisson_bounds() -> list[str]:
    """Eight hex digits from which on a uniform draw stands for at least 1, 2, ... events of a mean of 1."""
    out, term, total = [], exp(-1.0), 0.0
    while True:
        total += term
        if round(total * 16**8) >= 16**8:
            return out
        out.append(f"{round(total * 16**8):08x}")
        term /= len(out)


def resampled(records: DataFrame, rounds: int, seed: int) -> DataFrame:
    """(country, round, m): means of Poisson resamples, a weight per record and round drawn from an md5 of
    both, so that it is one grouped sum however many records there are, and any engine draws the same.
    Tasks make the md5 of all rounds at once, in arrays, and pass on one sum a round and country."""
    spark, bounds = records.sparkSession, [int(x, 16) for x in poisson_bounds()]
    turns = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
    added = [int(abs(sin(k + 1)) * 2**32) for k in range(64)]

    def first_word(m: list):
        """The first four bytes of the md5 of one-block messages; m: its 16 words (arrays that broadcast, or None for 0)."""
        a, b, c, d = start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
        for k in range(64):
            if k < 16:
                f, g = d ^ (b & (c ^ d)), k
            elif k < 32:
                f, g = c ^ (d & (b ^ c)), (5 * k + 1) % 16
            elif k < 48:
                f, g = b ^ c ^ d, (3 * k + 5) % 16
            else:
                f, g = c ^ (b | ~d), 7 * k % 16
            f = f + (a + np.uint32(added[k]))
            if m[g] is not None:
                f = f + m[g]
            a, d, c, b = d, c, b, b + (f << np.uint32(turns[k]) | f >> np.uint32(32 - turns[k]))
        return (a + start[0]).byteswap()

    def draw(batches):
        sums: dict = {}
        for batch in batches:
            rows: dict = {}
            for i, country, f in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                head = f"{seed}:{'' if i is None else f'{i}:'}".encode()
                rows.setdefault((country, len(head)), []).append((head, f or 0.0))
            for (country, n), found in rows.items():
                weights, values = sums.setdefault(country, (np.zeros(rounds), np.zeros(rounds)))
                for at in range(0, len(found), 32):
                    part = found[at : at + 32]
                    heads = np.frombuffer(b"".join(h.ljust(64, b"\0") for h, _ in part), "<u4").reshape(-1, 16)
                    f = np.array([x for _, x in part])
                    low = 1
                    while low <= rounds:
                        high = min(rounds + 1, 10 ** len(str(low)))
                        tail = b"".join((b"\0" * n + str(k).encode() + b"\x80").ljust(56, b"\0") + (8 * (n + len(str(k)))).to_bytes(8, "little") for k in range(low, high))
                        tails = np.frombuffer(tail, "<u4").reshape(-1, 16)
                        words = [heads[:, k, None] | tails[None, :, k] if heads[:, k].any() or tails[:, k].any() else None for k in range(16)]
                        with np.errstate(over="ignore"):
                            u = first_word(words)
                        w = sum((u >= np.uint32(x)).astype(np.uint8) for x in bounds).astype(np.float64)
                        weights[low - 1 : high - 1] += w.sum(0)
                        values[low - 1 : high - 1] += f @ w
                        low = high
        for country, (weights, values) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([country] * rounds, pa.string()), pa.array(np.arange(1, rounds + 1, dtype=np.int32)), pa.array(weights), pa.array(values)], ["country", "round", "w", "v"])

    # Few and narrow rows, but rounds as much work each: dealt out to all tasks.
    dealt = records.select("i", "country", F.col("f").cast("double").alias("f")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "i")
    drawn = dealt.mapInArrow(draw, "country string, round int, w double, v double").where("w > 0")
    return drawn.groupBy("country", "round").agg((F.sum("v") / F.sum("w")).alias("m"))


def bootstrap(records: DataFrame, rounds: int = 2000, seed: int = 0) -> DataFrame:
    """95% intervals of macro F0.5 by country."""
    return resampled(records, rounds, seed).groupBy("country").agg(F.round(F.percentile("m", 0.025), 6).alias("lo"), F.round(F.percentile("m", 0.975), 6).alias("hi"))


def paired_bootstrap(a: DataFrame, b: DataFrame, rounds: int = 2000, seed: int = 0) -> DataFrame:
    """The same draws for two variants: the interval of the difference of their macro F0.5."""
    both = a.select("i", "country", F.col("f").alias("fa")).join(b.select("i", F.col("f").alias("fb")), "i")
    return bootstrap(both.withColumn("f", F.col("fa") - F.col("fb")), rounds, seed)


def auc_ap(scores: DataFrame) -> DataFrame:
    """scores: p, y. Area under the ROC curve (ties count half) and average precision, from the counts
    per distinct score; only those are put in order."""
    g = scores.groupBy("p").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    w = Window.orderBy(F.desc("p"))
    g = g.withColumns({"tp": F.sum("pos").over(w), "seen": F.sum("n").over(w)}).withColumn("neg", F.col("n") - F.col("pos"))
    g = g.withColumn("fp", F.col("seen") - F.col("tp"))
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)) / (F.sum("pos") * F.sum("neg"))
    ap = F.sum(F.col("pos") * F.col("tp") / F.col("seen")) / F.sum("pos")
    return g.agg(F.round(area, 6).alias("auc"), F.round(ap, 6).alias("ap"))


def percent_rank(d: DataFrame, value: str) -> DataFrame:
    """Average rank of a value in its country as a share of its rows."""
    by = Window.partitionBy("country")
    rank = F.rank().over(by.orderBy(value)) + (F.count("*").over(Window.partitionBy("country", value)) - 1) / 2.0
    return d.withColumn("pct", F.round(rank / F.count("*").over(by), 6))


def reweighted(records: DataFrame, mix: dict[str, float], rounds: int = 2000, seed: int = 0) -> DataFrame:
    """Macro F0.5 as it would be with these shares of countries: value, and its 95% interval from
    resampling each country on its own."""
    shares = F.create_map(*(F.lit(x) for c, w in mix.items() for x in (c, w / sum(mix.values()))))
    own = records.where(F.col("country").isin(*mix)).select("i", "country", "f")
    point = own.groupBy("country").agg(F.avg("f").alias("m")).agg(F.sum(F.try_element_at(shares, F.col("country")) * F.col("m")).alias("value"))
    means = resampled(own, rounds, seed).groupBy("round").agg(F.sum(F.try_element_at(shares, F.col("country")) * F.col("m")).alias("m"))
    interval = means.agg(F.percentile("m", 0.025).alias("lo"), F.percentile("m", 0.975).alias("hi"))
    return point.crossJoin(interval).select(*(F.round(c, 6).alias(c) for c in ("value", "lo", "hi")))


def feature_variants(table: DataFrame, scaled: list[str], drops: dict[str, list[str]]) -> dict[str, DataFrame]:
    """The same feature table in the forms that are compared: as it is; with the scaled features on their
    raw scale again (times ln_n, a column); with them as percent ranks in their country; and without each
    named group of features."""
    raw = table.withColumns({c: F.round(F.col(c) * F.col("ln_n"), 6) for c in scaled})
    ranked = table
    for c in scaled:
        ranked = percent_rank(ranked, c).withColumn(c, F.col("pct")).drop("pct")
    return {"base": table, "raw": raw, "rank": ranked, **{f"no_{k}": table.drop(*v) for k, v in drops.items()}}
