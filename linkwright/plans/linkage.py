"""A whole linkage run as stages that write their tables and are skipped where those are finished.

    prepare -> block -> features -> train | predict -> decide, evaluate, profile
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode_id, encode_id
from ..operators import decide, evaluate, learn, splits, validate
from ..operators import features as feat
from ..operators.blocking import Blocking, candidates, record_keys
from ..operators.normalize import normalize
from ..sources import files

#: Columns of a feature table that no model reads: keys, text, and what is only meaningful over all candidates.
NOT_INPUTS = {"i", "j", "country", "y", "fold", "cand_n_s1", "cand_rank", "cand_ratio", "cand_nm_gap", "lg_a", "lg_b"}


@dataclass(frozen=True)
class Run:
    """root: holds <split>/<split>_source{1,2,3}.tsv and <split>/<split>_ground_truth.tsv; out: the run's
    own folder. owner, tau: how matches are decided."""

    root: str
    out: str
    rules: str = "n2"
    any_script: bool = True
    blocking: Blocking = field(default_factory=Blocking)
    folds: int = 5
    seed: int = 42
    owner: str = "hard"
    tau: float = 0.75


def records(spark: SparkSession, run: Run, split: str) -> DataFrame:
    path = f"{run.out}/{split}/records-{run.rules}"
    return files.stage(spark, path, lambda: normalize(files.read_split(spark, run.root, split), run.rules, run.any_script))


def keys(spark: SparkSession, run: Run, split: str) -> DataFrame:
    """The records' keys, which blocking reads three times: asked with, counted, and as postings."""
    return files.stage(spark, f"{run.out}/{split}/keys", lambda: record_keys(records(spark, run, split), run.blocking))


def blocked(spark: SparkSession, run: Run, split: str) -> DataFrame:
    return files.stage(spark, f"{run.out}/{split}/candidates", lambda: candidates(records(spark, run, split), run.blocking, keys(spark, run, split)))


def truth(spark: SparkSession, run: Run, split: str) -> DataFrame:
    return files.id_pairs(files.read_id_lists(spark, f"{run.root}/{split}/{split}_ground_truth.tsv"))


def features(spark: SparkSession, run: Run, split: str, labelled: bool) -> DataFrame:
    """Features of every candidate pair, with y where the truth is known."""

    def make() -> DataFrame:
        out = feat.pair_features(blocked(spark, run, split), records(spark, run, split))
        if labelled:
            out = out.join(truth(spark, run, split).select("i", "j", F.lit(1).alias("y")), ["i", "j"], "left").na.fill(0, ["y"])
        return out

    return files.stage(spark, f"{run.out}/{split}/features", make)


def inputs(table: DataFrame) -> list[str]:
    return sorted(c for c, kind in table.dtypes if c not in NOT_INPUTS and kind != "string")


def train(spark: SparkSession, run: Run, split: str, **options) -> DataFrame:
    """Fits and saves one model per fold; returns the out-of-fold scores: i, j, src, country, fold, y, p."""
    table = features(spark, run, split, True)
    ids = records(spark, run, split).where("src = 1").select(F.col("eid").alias("i"), "country")
    strata = splits.buckets(ids, truth(spark, run, split))
    table = table.join(splits.folds(strata, run.folds, run.seed).select("i", "fold"), "i")
    columns = inputs(table)

    def make() -> DataFrame:
        out = None
        for k in range(run.folds):
            model = learn.fit(table.where(F.col("fold") != k), columns, **options)
            model.write().overwrite().save(f"{run.out}/model/fold-{k}")
            part = learn.score(model, table.where(F.col("fold") == k)).select("i", "j", F.col("src_b").alias("src"), "country", "fold", "y", "p")
            out = part if out is None else out.unionByName(part)
        return out

    return files.stage(spark, f"{run.out}/{split}/oof", make)


def predict(spark: SparkSession, run: Run, split: str) -> DataFrame:
    """Mean score of all folds' models: i, j, src, country, p."""
    table = features(spark, run, split, False)
    models = [learn.load(f"{run.out}/model/fold-{k}", inputs(table)) for k in range(run.folds)]
    keys = table.select("i", "j", F.col("src_b").alias("src"), "country")
    return files.stage(spark, f"{run.out}/{split}/scores", lambda: keys.join(learn.score_average(models, table), ["i", "j"]))


def decided(run: Run, scores: DataFrame) -> DataFrame:
    return decide.one_owner(scores, run.owner).where(F.col("p") >= run.tau)


def submit(spark: SparkSession, run: Run, split: str) -> DataFrame:
    """Writes the candidate and match files in the order of source 1 and returns what a check of them finds."""
    scores = predict(spark, run, split)
    source = files.read_source(spark, files.source_path(run.root, split, 1)).select("entity_id")
    ids = source.withColumn("pos", F.monotonically_increasing_id()).select("pos", encode_id(F.col("entity_id")).alias("i"))
    files.write_decisions(ids, scores, decided(run, scores), f"{run.out}/{split}/files")
    written = files.read_id_lists(spark, f"{run.out}/{split}/files/matches").select("id", F.array_join("ids", ",").alias("ids"))
    known = records(spark, run, split).where("src in (2, 3)").select(decode_id(F.col("eid")).alias("id"))
    return validate.validate(written, ids.select(decode_id(F.col("i")).alias("id")), known)


def report(spark: SparkSession, run: Run, split: str, scores: DataFrame) -> DataFrame:
    """Macro F0.5 and its parts, for ALL and each country, of scores of a split whose truth is known."""
    ids = records(spark, run, split).where("src = 1").select(F.col("eid").alias("i"), "country")
    return evaluate.summary(evaluate.per_record(ids, decided(run, scores).select("i", "j"), truth(spark, run, split)))
