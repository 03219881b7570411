"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, int64, pieces, table, texts

#: A model predicts a character from the three before it: four 16-bit codes make one 64-bit hash.
ORDER = 4
_SPACE = 32
_codes: list[np.ndarray] = []


@dataclass(frozen=True)
class Language:
    """bound: (language, 4-gram) rows up to which all models are broadcast; beyond it only the `ready` most
    frequent 4-grams are, and what else texts hold is looked up in the models' tables. sample: documents
    that scores and rejection are calibrated on at most (in expectation); they are not counted, and a
    language with fewer than `few` documents gives none. strict: deviations above a language's usual
    cross-entropy from which a prediction is not accepted."""

    bound: int = 4_000_000
    ready: int = 400_000
    sample: int = 3_000
    few: int = 50
    strict: float = 6.0
    step: int = 1 << 20


def _table() -> np.ndarray:
    """Code of each character of the basic plane, lower-cased; what is no letter or mark is a space."""
    if not _codes:
        out, letter = np.full(65536, _SPACE, np.uint16), np.zeros(65537, bool)
        for c in range(65536):
            kind = unicodedata.category(chr(c))[0]
            if kind in "LM":
                low = chr(c).lower()
                out[c] = ord(low) if len(low) == 1 and ord(low) < 65536 else c
                letter[c] = kind == "L"
        _codes.extend([out, letter])
    return _codes[0]


def symbols(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, text of each predicted code or -1, has a letter): the texts in one run, three spaces
    before each, runs of spaces within a text made one; predicted are a text's codes and a space after it."""
    codes = _table()
    gap = b" " * (ORDER - 1)
    data = np.frombuffer(gap + gap.join(found) + gap, np.uint8)
    chars = np.cumsum((data & 0xC0) != 0x80)
    sizes = np.array([len(x) for x in found], np.int64)
    first = np.cumsum(np.concatenate([[0], sizes[:-1] + len(gap)])) + len(gap)
    begin = chars[first - 1]
    end = np.where(sizes > 0, chars[first + sizes - 1], begin)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    y = codes[np.minimum(points, 65535)]
    astral = np.nonzero(points > 65535)[0]
    letters = _codes[1][np.minimum(points, 65536)]
    for c in np.unique(points[astral]).tolist():
        if unicodedata.category(chr(c))[0] == "L":
            at = astral[points[astral] == c]
            y[at], letters[at] = max(c & 0xFFFF, 33), True
    owner = np.full(len(points), -1, np.int32)
    for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
        owner[a : b + 1] = i
    inside = np.zeros(len(points) + 1, np.int64)
    np.cumsum(letters, out=inside[1:])
    has = inside[end] > inside[begin]
    space = y == _SPACE
    keep = ~space
    keep[0] = True
    keep[1:] |= ~space[:-1]
    within = np.ones(len(points), bool)
    within[np.concatenate([end[:, None] + np.arange(len(gap))[None, :], np.arange(len(gap))[None, :]]).reshape(-1)] = False
    keep |= ~within
    return y[keep], owner[keep], has


def grams(y: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each code from the fourth on."""
    z = y.astype(np.uint64)
    return z[:-3] << np.uint64(48) | z[1:-2] << np.uint64(32) | z[2:-1] << np.uint64(16) | z[3:]


def _count(config: Language):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def merge(parts: list) -> list:
            g, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            g, where = np.unique(g, return_inverse=True)
            return [(g, np.bincount(where, n).astype(np.int64))]

        for batch in batches:
            langs, found = batch.column(1).to_pylist(), texts(batch.column(0))
            for lang in dict.fromkeys(langs):
                own = [t for t, x in zip(found, langs, strict=True) if x == lang]
                for _, piece in pieces(own, config.step):
                    y, owner, _ = symbols(piece)
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(grams(y)[owner[3:] >= 0], return_counts=True))
                    if len(parts) > 12:
                        held[lang] = merge(parts)
        for lang, parts in held.items():
            g, n = merge(parts)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), int64(g.view(np.int64)), int64(n)], ["lang", "gram", "n"])

    return run


def _discount(once: float, twice: float) -> float:
    return float(once / (once + 2 * twice)) if once and twice else 0.5


def kneser_ney(hashes: np.ndarray, counts: np.ndarray) -> tuple:
    """One language's model as plain arrays. Each order holds sorted hashes with (count - discount) /
    context total, and sorted context hashes with the weight that its unseen mass gives the order below."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order].astype(np.float64)
    levels = []
    for bits in (64, 48, 32):
        d = _discount((counts == 1).sum(), (counts == 2).sum())
        contexts, where, types = np.unique(hashes >> np.uint64(16), return_inverse=True, return_counts=True)
        total = np.bincount(where, counts)
        levels.append((hashes, (counts - d) / total[where], contexts, d * types / total, np.uint64((1 << bits) - 1)))
        hashes, counts = np.unique(hashes & np.uint64((1 << (bits - 16)) - 1), return_counts=True)
        counts = counts.astype(np.float64)
    total = counts.sum()
    return levels, hashes, (counts - LAST) / total, LAST * len(counts) / total / (len(counts) + 1)


#: Discount of the lowest order, whose unseen mass goes to one more character.
LAST = 0.5


def log_p(model: tuple, g: np.ndarray) -> np.ndarray:
    levels, single, single_p, other_p = model

    def find(keys, values, sought, default):
        at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
        return np.where(keys[at] == sought, values[at], default)

    p = find(single, single_p, g & np.uint64(0xFFFF), 0.0) + other_p
    for hashes, share, contexts, left, mask in reversed(levels):
        sought = g & mask
        p = find(hashes, share, sought, 0.0) + find(contexts, left, sought >> np.uint64(16), 1.0) * p
    return np.log(p)


def _score(ready: tuple, each: list[tuple] | None, found: list[bytes], step: int):
    """(sums of log probabilities by language, predicted characters, has a letter) of each text, and
    (text, 4-gram) of what neither the ready table nor, if given, the models have worked out.

    ready: sorted 4-grams and their log probabilities by language; each: whole models, if they are here.
    """
    hashes, values_of = ready
    sums, n, has = np.zeros((len(found), values_of.shape[1])), np.zeros(len(found), np.int64), np.zeros(len(found), bool)
    rest = []
    for at, piece in pieces(found, step):
        y, owner, letter = symbols(piece)
        has[at : at + len(piece)] = letter
        g, owner = grams(y), owner[3:]
        g, owner = g[owner >= 0], owner[owner >= 0] + at
        for lo in range(0, len(g), step):
            part, own = g[lo : lo + step], owner[lo : lo + step]
            where = np.minimum(np.searchsorted(hashes, part), len(hashes) - 1)
            values = values_of[where]
            new = np.nonzero(hashes[where] != part)[0]
            if len(new) and each is None:
                values[new] = 0.0
                rest.append((own[new], part[new]))
            elif len(new):
                unseen, back = np.unique(part[new], return_inverse=True)
                values[new] = np.stack([log_p(m, unseen) for m in each], 1)[back]
            starts = np.concatenate([[0], np.nonzero(own[1:] != own[:-1])[0] + 1])
            sums[own[starts]] += np.add.reduceat(values, starts, axis=0, dtype=np.float64)
            n += np.bincount(own, minlength=len(found))
    return sums, n, has, rest


_SCORED = "doc_id long, lang string, n long, letters boolean, sums array<double>"


def _scored(models, config: Language):
    """Scores by whole models: models.value is (ready table, models), nothing but arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, n, has, _ = _score(*models.value, texts(batch.column(2)), config.step)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), int64(n), pa.array(has), pa.array(list(sums), pa.list_(pa.float64()))], ["doc_id", "lang", "n", "letters", "sums"])

    return run


def _broadcast_models(spark: SparkSession, held: pa.Table, names: list[str], config: Language):
    """held: lang, gram, n."""
    which = pc.index_in(held.column("lang"), pa.array(names)).to_numpy()
    order = np.argsort(which, kind="stable")
    cut = np.cumsum(np.bincount(which, minlength=len(names)))[:-1]
    g, n = (held.column(c).to_numpy()[order] for c in ("gram", "n"))
    g = g.view(np.uint64)
    each = [kneser_ney(a, b) for a, b in zip(np.split(g, cut), np.split(n, cut), strict=True)]
    hashes, where = np.unique(g, return_inverse=True)
    if len(hashes) > config.ready:
        hashes = np.sort(hashes[np.argsort(-np.bincount(where, n), kind="stable")[: config.ready]])
    values = np.stack([log_p(m, hashes) for m in each], 1).astype(np.float32)
    return spark.sparkContext.broadcast(((hashes, values), each))


# ---------------------------------------------------------------- models beyond what is broadcast


class Tables:
    """The same models as written tables, for any number of 4-grams: counts of every order by grouped
    sums, joined by hash; only discounts and, by language, at most 65,536 single characters are small."""

    def __init__(self, work: Work, counts: DataFrame, names: list[str]):
        self.work, self.names = work, names
        self.langs = counts.sparkSession.createDataFrame([(x,) for x in names], "lang string")
        level = counts.select("lang", F.col("gram").alias("h"), F.col("n").cast("double").alias("c"))
        self.levels = []
        for bits in (64, 48, 32):
            level = work.save(level, f"grams-{bits}")
            d = {r["lang"]: _discount(r["once"], r["twice"]) for r in level.groupBy("lang").agg(F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")).collect()}
            discount = F.element_at(F.create_map(*(F.lit(x) for kv in d.items() for x in kv)), F.col("lang"))
            contexts = level.groupBy("lang", F.shiftrightunsigned("h", 16).alias("ctx")).agg(F.sum("c").alias("total"), F.count("*").alias("types"))
            contexts = work.save(contexts.select("lang", "ctx", "total", (discount * F.col("types") / F.col("total")).alias("left")), f"contexts-{bits}")
            shares = level.withColumn("ctx", F.shiftrightunsigned("h", 16)).join(contexts, ["lang", "ctx"]).select("lang", "h", ((F.col("c") - discount) / F.col("total")).alias("share"))
            self.levels.append((work.save(shares, f"shares-{bits}"), contexts.select("lang", "ctx", "left"), (1 << bits) - 1 if bits < 64 else -1))
            level = level.groupBy("lang", F.col("h").bitwiseAND((1 << (bits - 16)) - 1).alias("h")).agg(F.count("*").cast("double").alias("c"))
        level = work.save(level, "grams-16")
        total = level.groupBy("lang").agg(F.sum("c").alias("total"), F.count("*").alias("types"))
        other = (LAST * F.col("types") / F.col("total") / (F.col("types") + 1)).alias("other")
        self.single = level.join(total, "lang").select("lang", "h", ((F.col("c") - LAST) / F.col("total")).alias("share"))
        self.other = total.select("lang", other)

    def log_p(self, wanted: DataFrame) -> DataFrame:
        """wanted: distinct gram. (gram, p): the log probabilities by language, in the order of names."""
        d = wanted.crossJoin(F.broadcast(self.langs)).join(F.broadcast(self.other), "lang")
        d = d.withColumn("h", F.col("gram").bitwiseAND(0xFFFF)).join(self.single, ["lang", "h"], "left")
        d = d.select("lang", "gram", (F.coalesce("share", F.lit(0.0)) + F.col("other")).alias("p"))
        for shares, contexts, mask in reversed(self.levels):
            d = d.withColumn("h", F.col("gram").bitwiseAND(mask)).withColumn("ctx", F.shiftrightunsigned("h", 16))
            d = d.join(shares, ["lang", "h"], "left").join(contexts, ["lang", "ctx"], "left")
            d = d.select("lang", "gram", (F.coalesce("share", F.lit(0.0)) + F.coalesce("left", F.lit(1.0)) * F.col("p")).alias("p"))
        by_lang = F.array_sort(F.collect_list(F.struct("lang", F.log("p").alias("p"))))
        return d.groupBy("gram").agg(F.transform(by_lang, lambda x: x["p"]).alias("p"))


def _by_tables(spark: SparkSession, work: Work, counts: DataFrame, plain: DataFrame, names: list[str], config: Language) -> DataFrame:
    """The result of _scored without ever holding a whole model: the most frequent 4-grams are broadcast,
    texts are scored on those, and their other 4-grams are summed by joins with the models' tables."""
    tables = Tables(work, counts, names)
    frequent = counts.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(config.ready).select("gram")
    held = work.save(tables.log_p(frequent), "ready").toPandas()
    hashes = held["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    ready = spark.sparkContext.broadcast((hashes[order], np.stack(held["p"].to_numpy())[order].astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            m = batch.num_rows
            sums, n, has, rest = _score(ready.value, None, texts(batch.column(2)), config.step)
            own, g = (np.concatenate([x[i] for x in rest]) if rest else np.empty(0, np.int64) for i in (0, 1))
            order = np.lexsort([g, own])
            own, g = own[order].astype(np.int64), g[order].astype(np.uint64)
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (own[1:] != own[:-1])]) if len(g) else np.empty(0, bool)
            first = np.nonzero(new)[0]
            times = np.diff(np.append(first, len(g)))
            ends = np.searchsorted(own[first], np.arange(m + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), int64(x)) for x in (g[first].view(np.int64), times)]
            yield pa.RecordBatch.from_arrays([int64((task << 40) + k + np.arange(m)), *batch.columns[:2], int64(n), pa.array(has), pa.array(list(sums), pa.list_(pa.float64())), *lists], ["row", "doc_id", "lang", "n", "letters", "sums", "grams", "times"])
            k += m

    schema = f"row long, {_SCORED}, grams array<long>, times array<long>"
    part = work.save(plain.select("doc_id", "lang", "text").mapInArrow(run, schema), "part")
    rest = part.select("row", F.explode(F.arrays_zip("grams", "times")).alias("x")).select("row", F.col("x.grams").alias("gram"), F.col("x.times").alias("times"))
    worth = work.save(tables.log_p(rest.select("gram").distinct()), "worth")
    more = rest.join(worth, "gram").groupBy("row").agg(F.array(*(F.sum(F.col("times") * F.col("p")[i]) for i in range(len(names)))).alias("more"))
    sums = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    return part.join(more, "row", "left").select("doc_id", "lang", "n", "letters", sums.alias("sums"))


def identify(spark: SparkSession, docs: DataFrame, learn: Column, config: Language = Language()) -> DataFrame:
    """docs: doc_id (long), text, lang; learn: of which rows text and lang may be used. One row per
    document: doc_id, lang_pred, score, entropy (nats per character), accepted.

    4-gram counts are summed over all rows to learn from, and all of them are kept; lang_pred is the
    language of the lowest cross-entropy per character, score its calibrated probability; accepted is
    false where the cross-entropy is far above what the language usually has, or nothing is predicted.
    Nulls: a null text, or one without a letter, is `und` with score 0; rows of null lang are not
    learned from; null doc_id changes nothing. With nothing to learn from all are `und`. Ties go to
    the first language by name. Repeated rows count each. Very long texts are worked on a piece at a
    time. Empty input gives no rows. Other columns are ignored, whatever their names.
    """
    work = Work(spark, "language")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.coalesce(learn, F.lit(False)).alias("learn"))
    known = plain.where("learn and lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # Of each language up to a tenth is held out of the counts, to calibrate on.
    large = {x: n for x, n in sizes.items() if n >= config.few}
    share = min(0.1, config.sample / max(sum(large.values()), 1))
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit(2)), F.lit(1 << 40)) < int(share * (1 << 40))
    drawn = drawn & F.col("lang").isin(*large)
    counts = known.where(~drawn).select("text", "lang").mapInArrow(_count(config), "lang string, gram long, n long")
    counts = work.save(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "counts")
    rows, names = counts.count(), sorted(r[0] for r in counts.select("lang").distinct().collect())
    none = [F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(False).alias("accepted")]
    if not rows:
        return plain.select("doc_id", *none)
    sample = known.where(drawn).limit(2 * config.sample)
    if rows <= config.bound:
        models = _broadcast_models(spark, counts.toArrow(), names, config)
        out, sample = (d.select("doc_id", "lang", "text").mapInArrow(_scored(models, config), _SCORED) for d in (plain, sample))
    else:
        out, sample = (_by_tables(spark, Work(spark, "language"), counts, d, names, config) for d in (plain, sample))
    entropy = F.transform("sums", lambda s: -s / F.greatest("n", F.lit(1)))
    heat, usual = _calibrate(sample.where("letters").select("lang", "n", entropy.alias("entropy")).toPandas(), names)

    out = out.select("doc_id", "n", "letters", entropy.alias("entropy"))
    lowest = F.array_min("entropy")
    which = (F.array_position("entropy", lowest) - 1).cast("int")
    steep = F.lit(heat) * F.sqrt("n")
    odds = F.aggregate("entropy", F.lit(0.0), lambda s, h: s + F.exp(-steep * (h - lowest)))
    mean, spread = (F.array(*(F.lit(float(u[i])) for u in usual)) for i in (0, 1))
    usual_enough = (lowest - F.get(mean, which)) * F.sqrt("n") <= config.strict * F.get(spread, which)
    pick = F.get(F.array(*map(F.lit, names)), which)
    return out.select("doc_id", F.when(F.col("letters"), pick).otherwise("und").alias("lang_pred"), F.when(F.col("letters"), 1 / odds).otherwise(0.0).alias("score"), F.when(F.col("letters"), lowest).alias("entropy"), (F.col("letters") & usual_enough).alias("accepted"))


def _calibrate(sample, names: list[str]) -> tuple[float, list[tuple[float, float]]]:
    """(the steepness of probabilities that fits the labels best, each language's mean cross-entropy and
    its spread per square root of a character)."""
    usual = [(0.0, 1e9)] * len(names)
    if not len(sample):
        return 1.0, usual
    h, n = np.stack(sample["entropy"].to_numpy()), sample["n"].to_numpy()
    index = {x: i for i, x in enumerate(names)}
    y = np.array([index.get(x, -1) for x in sample["lang"]])
    h, n, y = h[y >= 0], n[y >= 0], y[y >= 0]
    best = (np.inf, 1.0)
    for heat in 2.0 ** np.arange(-4, 6):
        z = -heat * np.sqrt(n)[:, None] * (h - h.min(1, keepdims=True))
        loss = -(z[np.arange(len(y)), y] - np.log(np.exp(z).sum(1))).mean() if len(y) else 0.0
        best = min(best, (float(loss), float(heat)))
    for i in range(len(names)):
        own = h[y == i, i]
        if len(own) > 1:
            off = (own - np.median(own)) * np.sqrt(n[y == i])
            usual[i] = float(np.median(own)), float(max(np.sqrt((off**2).mean()), 1e-3))
    return best[1], usual


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(spark, docs, remainder != 0)
    return found.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")
