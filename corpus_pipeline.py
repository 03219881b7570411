"""A training corpus from the documents table: quality, lines, near copies, benchmark passages, mixture.

STAGES are applied in order, each to what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import Work, table
from linkwright.llm.decontaminate import decontaminate
from linkwright.llm.lines import emptied, line_dedup
from linkwright.llm.minhash import minhash_dedup
from linkwright.llm.mixing import documents_mix
from linkwright.llm.quality import documents_quality


# Of every stage but the last: a document with null doc_id stays, all rows of one doc_id stay or go
# together, other columns come back as they were whatever their names, and no documents give none.


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs whose doc_id is not in gone."""
    return docs.join(gone.select("doc_id").hint("merge"), "doc_id", "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. A null or empty text is judged by its lack of
    words; of rows of one doc_id one rejected is enough; texts are read whole, however long."""
    return _without(docs, documents_quality(spark, docs, sf_dir).where("rejected"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one, n_chars (if there) told anew where lines
    went; a row that loses every line goes, one with a null or blank text stays. Rows of one doc_id lose
    equal lines together, and of tied lines the smallest doc_id's stays."""
    # Columns of these names are not the documents' own to line_dedup.
    held = {c: f"{c}{'_' * (1 + max(map(len, docs.columns)))}" for c in ("n_lines", "n_dropped") if c in docs.columns}
    out = line_dedup(spark, docs.withColumnsRenamed(held)).where(~emptied())
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in held.items()}).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id, with all its rows. Texts
    without words are no one's copies."""
    return _without(docs, minhash_dedup(spark, docs).where(~F.col("kept")))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item; of rows of one doc_id one hit is enough. Null
    texts hold none."""
    hit = decontaminate(spark, docs, table(spark, sf_dir, "benchmark")).where("size(items) > 0")
    return _without(docs, hit)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is to be used: doc_id, n_tokens, domain posteriors, rate, tokens; a row for
    each row, null doc_ids and texts too (no tokens, rate 1)."""
    return documents_mix(spark, docs, sf_dir)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", benchmark), ("mixing", mixture)]

#: Likelihood screens, logistic fits and descent steps are not SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, docs = Work(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), f"stage-{k}")
        work.clear(f"stage-{k}")
    return docs
