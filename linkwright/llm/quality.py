"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, table, texts


@dataclass(frozen=True)
class Quality:
    """max_train: labelled documents, drawn by a hash of their id, that the document classifier is
    fitted on at most (in expectation). threshold: a document below this posterior is rejected.
    ridge: of the fit. site_weight: of a site's log odds against the global ones."""

    max_train: int = 20_000
    threshold: float = 0.5
    ridge: float = 1.0
    site_weight: float = 1.0


FEATURES = ("log_words", "word_length", "distinct", "repeated", "symbols", "marked_words", "bare_marks", "digits", "capitals", "stops", "long_words", "line_words", "repeated_lines", "links")

_KIND = np.zeros(256, np.uint8)
for _set, _code in ((b"0123456789", 1), (bytes(range(65, 91)), 2), (b".!?", 3), (b"#$%&*+<=>@[]^_`{|}~\\/", 4)):
    for _b in _set:
        _KIND[_b] = _code
_MARKS = bytes(b for b in range(256) if _KIND[b] == 4)


def features(text: bytes) -> list[float]:
    """Shares and rates of one whole text, in the order of FEATURES; of an empty one all 0."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=5) / len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    marked = sum(1 for w in words if w[-1] in _MARKS) / n if kinds[4] else 0.0
    bare = sum(1 for w in words if not w.strip(_MARKS)) / n if kinds[4] else 0.0
    lengths = np.fromiter(map(len, words), np.int64, n)
    same = sum(map(bytes.__eq__, words, words[1:])) / n
    return [
        float(np.log1p(n)), float(lengths.mean()), len(set(words)) / n**0.8, same, float(kinds[4]), marked, bare, float(kinds[1]), float(kinds[2]),
        float(kinds[3] * len(text) / n), float((lengths > 25).mean()), float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines), text.count(b"://") / n,
    ]


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [features(t) for t in texts(b.column(3))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "host", "path", "x"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, scale, weights with the intercept last) of a ridge logistic regression, by Newton steps."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.clip((x - centre) / scale, -8, 8), np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, mean: Column) -> float:
    """Prior strength of a level by moments: how many documents its parent's mean weighs as much as.
    sites: n, s, parent mean; the spread of the sites' means beyond what their sizes explain."""
    m = F.col("s") / F.col("n")
    row = sites.agg(F.sum(F.col("n") * (m - mean) ** 2).alias("q"), F.sum(mean * (1 - mean)).alias("noise"), F.sum("n").alias("n"), F.sum(F.col("n") * mean * (1 - mean)).alias("v")).first()
    if not row["n"] or not row["v"]:
        return 1e6
    spread = max((row["q"] - row["noise"]) / row["n"], 1e-9)
    return float(min(max(row["v"] / row["n"] / spread - 1, 1.0), 1e6))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, host: Column, path: Column, config: Quality = Quality()) -> DataFrame:
    """docs: doc_id (long), text and what host and path are made of; labels: doc_id, quality (0 or 1).

    One row per document: doc_id, host, path, p_document (the classifier's probability), p_site (its
    path's posterior mean without the document itself) and p_quality, the posterior of both; rejected
    says that this is below the threshold. Sites' means are grouped sums over all documents, a label
    standing for the classifier's probability where there is one; a path shrinks toward its host, a
    host toward the global mean, by strengths estimated from the spread between them.
    Nulls: a null or empty text has no features; null host or path is the site ''. A null or other
    label is none, several of one document are averaged. Without labels of both kinds nothing can be
    learned: all probabilities are 1. Repeated rows are classified alike, and each counts for its site;
    ties of evidence give equal posteriors. Texts are read whole, a very long one in some 60 bytes a word.
    Empty input gives no rows. Other columns are ignored, whatever their names.
    """
    work = Work(spark, "quality")
    site = [F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path")]
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *site, F.col("text").cast("string").alias("text"))
    seen = work.save(plain.mapInArrow(_profile, "doc_id long, host string, path string, x array<double>"), "profile")
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).where("doc_id is not null and y in (0, 1)")
    given = work.save(given.groupBy("doc_id").agg(F.avg("y").alias("y")), "labels")
    n = given.count()
    drawn = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * min(1.0, config.max_train / max(n, 1))))
    train = seen.join(drawn, "doc_id").where("y in (0, 1)").select("x", "y").toPandas()
    y = train["y"].to_numpy(float)
    if len(np.unique(y)) < 2:
        one = F.lit(1.0)
        return seen.select("doc_id", "host", "path", one.alias("p_document"), one.alias("p_site"), one.alias("p_quality"), F.lit(False).alias("rejected"))
    centre, scale, w = fit_logistic(np.stack(train["x"].to_numpy()), y, config.ridge)
    at = [F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col("x")[k] - F.lit(float(centre[k]))) / F.lit(float(scale[k])))) * F.lit(float(w[k])) for k in range(len(centre))]
    z = F.lit(float(w[-1]))
    for term in at:
        z = z + term
    scored = seen.select("doc_id", "host", "path", (1 / (1 + F.exp(-z))).alias("p_document")).join(given, "doc_id", "left")
    scored = work.save(scored.withColumn("e", F.coalesce("y", "p_document")).drop("y"), "scored")

    paths = work.save(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("e").alias("s")), "paths")
    total = paths.agg(F.sum("s") / F.sum("n")).first()[0]
    mean = F.lit(float(total if total is not None else 0.5))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k_host = F.lit(_strength(hosts, mean))
    hosts = work.save(hosts.select("host", ((F.col("s") + k_host * mean) / (F.col("n") + k_host)).alias("m_host")), "hosts")
    paths = work.save(paths.join(hosts, "host"), "sites")
    k_path = F.lit(_strength(paths, F.col("m_host")))
    joined = scored.join(paths, ["host", "path"])
    p_site = (F.col("s") - F.col("e") + k_path * F.col("m_host")) / (F.col("n") - 1 + k_path)
    odds = _logit(F.col("p_document")) + config.site_weight * (_logit(F.col("p_site")) - _logit(mean))
    out = joined.withColumn("p_site", p_site).withColumn("p_quality", 1 / (1 + F.exp(-odds)))
    return out.select("doc_id", "host", "path", "p_document", "p_site", "p_quality", (F.col("p_quality") < config.threshold).alias("rejected"))


def url_site(url: Column) -> tuple[Column, Column]:
    """Host and first path segment of a url."""
    return F.parse_url(url, F.lit("HOST")), F.regexp_extract(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), "^/([^/]*)", 1)


def documents_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents table: source is the host, lang the path below it."""
    return classify(spark, docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_quality(spark, table(spark, sf_dir, "documents"), sf_dir)
