"""Mixing to target weights: soft domain membership, and document rates by projected gradient. Native throughout."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, table


@dataclass(frozen=True)
class Mixing:
    """max_train: labelled documents, drawn by a hash of their id, that the classifier is fitted on at
    most (in expectation). buckets: of token hashes; with domains and folds they bound the table of
    weights that is broadcast. folds: of the documents fitted on, each scored without its own fold.
    shrink: pseudo counts that draw a token's weight to none. doubt: squared deviations at which a
    token's weight counts an eighth. steps, tolerance: of the descent, the latter as a share of all
    tokens."""

    max_train: int = 20_000
    buckets: int = 1 << 17
    folds: int = 3
    shrink: float = 1.0
    doubt: float = 8.0
    steps: int = 60
    tolerance: float = 1e-6


#: A token: a run of letters, marks and digits, or of other signs.
_TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N} ]+"


def _tokens(docs: DataFrame, config: Mixing) -> DataFrame:
    """docs without text, with n_words and bucket, a row per token: runs of letters and of signs, and
    one that stands for each word that repeats the one before it. A text without any has one row with a
    null bucket."""
    plain = F.lower(F.coalesce("text", F.lit("")))
    for space in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    d = docs.withColumn("text", plain)
    words = F.filter(F.split("text", " "), lambda w: w != "")
    again = F.size(F.filter("w", lambda w, i: (i > 0) & (w == F.get("w", i - 1))))
    d = d.withColumn("w", words).withColumn("n_words", F.size("w").cast("long"))
    d = d.withColumn("token", F.explode_outer(F.concat(F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0)), F.array_repeat(F.lit("\x01"), again))))
    return d.drop("text", "w").withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(config.buckets)).cast("int")).withColumn("bucket", F.when(F.col("token").isNotNull(), F.col("bucket"))).drop("token")


def posteriors(spark: SparkSession, work: Work, docs: DataFrame, labelled: DataFrame, domains: list[str], config: Mixing) -> DataFrame:
    """(doc_id, n_tokens, p_0, p_1, ...): each document's words and probabilities of the domains.

    Multinomial evidence: a token's weight for a domain is the log of its count there over the count
    expected at its overall rate, both plus `shrink`, times (z / (z + doubt))^3. z is the squared
    deviation, in standard ones, of the number of the domain's documents that hold it: texts repeat their
    own words, so counts alone take what one document happens to say for the domain's. The doubt has the
    N - K degrees of freedom that N documents of K domains leave, as a share. A document that the weights
    are fitted on is scored with the weights of the other folds.
    """
    k = len(domains)
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    given = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    given = work.save(given, "given")
    n = given.count()
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    taken = drawn < int(1e6 * min(1.0, config.max_train / max(n, 1)))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(config.folds)).cast("int")
    priors = {r["domain"]: r["c"] for r in given.groupBy("domain").agg(F.count("*").alias("c")).collect()}
    train = docs.where(taken).join(given.where(taken).hint("merge"), "doc_id").select("row", "domain", fold.alias("fold"), "text")
    seen = _tokens(train, config).groupBy("row", "domain", "fold", "bucket").agg(F.count("bucket").alias("c"))
    seen = work.save(seen.groupBy("fold", "domain", "bucket").agg(F.sum("c").alias("c"), F.count("*").alias("d")), "seen")
    members = work.save(train.groupBy("fold", "domain").agg(F.count("*").alias("docs")), "members-train").collect()
    totals = {(r["fold"], r["domain"]): r["c"] for r in seen.groupBy("fold", "domain").agg(F.sum("c").alias("c")).collect()}

    def kept(f: int) -> list[int]:
        """The folds that the f-th set of weights is made from; the last one is of all."""
        return [x for x in range(config.folds) if x != f]

    sums = [F.sum(F.when((F.col("domain") == d) & F.col("fold").isin(kept(f)), F.col(x)).otherwise(0)).cast("double").alias(f"{x}{i}_{f}") for f in range(config.folds + 1) for i, d in enumerate(domains) for x in "cd"]
    counts = seen.where("bucket is not null").groupBy("bucket").agg(*sums)

    def weight(i: int, f: int) -> Column:
        in_all = [sum(float(totals.get((x, d)) or 0) for x in kept(f)) for d in domains]
        of_all = [sum(float(r["docs"]) for r in members if r["domain"] == d and r["fold"] in kept(f)) for d in domains]
        tokens, documents = sum(in_all) or 1.0, sum(of_all) or 1.0
        here, held = (sum((F.col(f"{x}{j}_{f}") for j in range(k)), F.lit(0.0)) for x in "cd")
        share = of_all[i] / documents
        doubt = config.doubt * max(0.0, 1 - k / documents)
        z = (F.col(f"d{i}_{f}") - held * share) ** 2 / (held * share * (1 - share) + 0.5) + 1e-9
        return F.log((F.col(f"c{i}_{f}") + config.shrink) / (here * (in_all[i] / tokens) + config.shrink)) * F.pow(z / (z + doubt), F.lit(3))

    weights = counts.select("bucket", F.array(*(weight(i, f) for f in range(config.folds + 1) for i in range(k))).alias("w"))
    weights = work.save(weights, "weights")

    own = given.where(taken).select("doc_id", fold.alias("fold"))
    hits = _tokens(docs.join(F.broadcast(own), "doc_id", "left"), config).join(F.broadcast(weights), "bucket", "left")
    at = F.coalesce("fold", F.lit(config.folds)) * k
    sums = hits.groupBy("row", "doc_id", "n_words").agg(*(F.sum(F.get("w", at + i)).alias(f"s{i}") for i in range(k)))
    prior = [float(np.log((priors.get(d, 0) + 1) / (n + k))) for d in domains]
    scores = [F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.lit(prior[i]) for i in range(k)]
    top = F.greatest(*scores, F.lit(float("-inf")))
    e = [F.exp(s - top) for s in scores]
    norm = sum(e[1:], e[0])
    return sums.select("doc_id", F.col("n_words").alias("n_tokens"), *((x / norm).alias(f"p_{i}") for i, x in enumerate(e)))


def fit_rates(spark: SparkSession, members: DataFrame, targets: list[float], config: Mixing) -> DataFrame:
    """members: n_tokens, p_0 ... (a written table). Adds rate: nonnegative, from 1 by projected gradient
    on the squared distances of the domains' expected token totals from targets[k] of all tokens.

    In the metric of the tokens a step takes sum_k p_k g_k from a document's rate and stops at 0, so a
    rate follows from the few vectors g of all steps: each step is one sum over the table, and only K
    totals and the K x K curvature reach the driver. g is the residual scaled by the curvature over the
    documents whose rate is not at 0; where that did not bring the error down, by the diagonal of the
    whole curvature over its largest scaled eigenvalue, which always does.
    """
    k = len(targets)
    p = [F.col(f"p_{i}") for i in range(k)]
    t = F.col("n_tokens").cast("double")
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    steps: list[list[float]] = []

    def rate() -> Column:
        if not steps:
            return F.lit(1.0)
        taken = F.array(*(F.array(*(F.lit(float(x)) for x in g)) for g in steps))
        return F.aggregate(taken, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - sum((p[i] * g[i] for i in range(1, k)), p[0] * g[0])))

    def sums() -> tuple[float, np.ndarray, np.ndarray]:
        d = members.select("n_tokens", *p, rate().alias("r"))
        free = F.when(F.col("r") > 0, t).otherwise(0.0)
        row = [float(x or 0) for x in d.agg(F.sum(t), *(F.sum(F.col("r") * t * x) for x in p), *(F.sum(free * p[i] * p[j]) for i, j in upper)).first()]
        m = np.zeros((k, k))
        for (i, j), x in zip(upper, row[1 + k :], strict=True):
            m[i, j] = m[j, i] = x
        return row[0], np.array(row[1 : 1 + k]), m

    total, now, m = sums()
    goal = np.array(targets) / (sum(targets) or 1) * total
    scale = np.where(np.diag(m) > 0, 1 / np.maximum(np.diag(m), 1e-300), 0)
    root = np.sqrt(scale)
    safe = scale / max(float(np.linalg.eigvalsh(root[:, None] * m * root[None, :]).max()), 1e-12)
    least = np.inf
    for _ in range(config.steps):
        short = now - goal
        if np.abs(short).max() <= config.tolerance * max(total, 1):
            break
        error = float((scale * short * short).sum())
        bent = root[:, None] * m * root[None, :]
        steps.append((safe * short if error > 0.9 * least else root * (np.linalg.pinv(bent, rcond=1e-6) @ (root * short))).tolist())
        least = min(least, error)
        _, now, m = sums()
    return members.withColumn("rate", F.when(F.col("n_tokens") > 0, rate()).otherwise(1.0))


def mix(spark: SparkSession, docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], config: Mixing = Mixing()) -> DataFrame:
    """docs: doc_id (long), text; labelled: doc_id, domain; targets: the share of all tokens that each
    domain should have. One row per document: doc_id, n_tokens (words), p_<domain> (posterior), rate
    (how often the document is to be used) and tokens (rate times n_tokens).

    Nulls: a null or empty text has no tokens, rate 1; a null doc_id matches no label. A label that is
    not a target's domain is none; of several for one document the first by name counts. Without any
    label memberships are the same for all, and the targets are met as well as they allow. A domain
    that no document belongs to cannot be met and is left out. Repeated rows get equal rates; empty
    input gives no rows. Very long texts are exploded whole, a row per token, as all are; documents of
    equal scores get equal rates. Other columns are ignored, whatever their names.
    """
    work = Work(spark, "mixing")
    domains = sorted(targets)
    members = work.save(posteriors(spark, work, docs, labelled.select(F.col("doc_id").cast("long"), F.col("domain").cast("string").alias("domain")), domains, config), "members")
    rated = fit_rates(spark, members, [float(targets[d]) for d in domains], config)
    return rated.select("doc_id", "n_tokens", *(F.col(f"p_{i}").alias(f"p_{d}") for i, d in enumerate(domains)), "rate", (F.col("rate") * F.col("n_tokens")).alias("tokens"))


#: Domains of the labels table, and the token shares asked for.
TARGETS = {"clean": 0.92, "junk": 0.05, "toxic": 0.03}


def label_domains(labels: DataFrame) -> DataFrame:
    domain = F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def documents_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(spark, docs, label_domains(table(spark, sf_dir, "labels")), TARGETS)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_mix(spark, table(spark, sf_dir, "documents"), sf_dir)
