"""Tab-separated sources and id lists, and the stores and reports the stages write."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode_id, encode_id, transliterate

SOURCE = ["entity_id", "business_name", "business_address", "country"]


def _tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Strings only, no quoting, no null marks; a line with another number of fields is an error."""
    schema = ", ".join(f"{c} string" for c in columns)
    read = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("mode", "FAILFAST").option("enforceSchema", False)
    return read.csv(path)


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """A source: its four columns, trimmed, absent cells empty, and source, the id's first two characters."""
    d = _tsv(spark, path, SOURCE)
    return d.select(*(F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in SOURCE)).withColumn("source", F.substring("entity_id", 1, 2))


def source_path(root: str, split: str, k: int) -> str:
    return f"{root}/{split}/{split}_source{k}.tsv"


def read_split(spark: SparkSession, root: str, split: str) -> DataFrame:
    """All three sources of a split as records: eid, src, country, name_raw, addr_raw."""
    parts = [read_source(spark, source_path(root, split, k)) for k in (1, 2, 3)]
    return as_records(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def as_records(source: DataFrame) -> DataFrame:
    eid = encode_id(F.col("entity_id"))
    good = F.when(eid.isNotNull(), eid).otherwise(F.raise_error(F.concat(F.lit("bad entity id: "), "entity_id")).cast("long"))
    return source.select(good.alias("eid"), F.substring("entity_id", 2, 1).cast("int").alias("src"), "country", F.col("business_name").alias("name_raw"), F.col("business_address").alias("addr_raw"))


def read_id_lists(spark: SparkSession, path: str, column: str = "matched_entity_ids") -> DataFrame:
    """(id, ids): an id-list file's rows with their ids as an array, trimmed, blanks dropped."""
    d = _tsv(spark, path, ["source1_entity_id", column])
    return d.select(F.col("source1_entity_id").alias("id"), parse_ids(F.coalesce(F.col(column), F.lit(""))).alias("ids"))


def parse_ids(c):
    return F.filter(F.transform(F.split(c, ","), lambda t: F.trim(t)), lambda x: x != "")


def id_pairs(lists: DataFrame) -> DataFrame:
    """(i, j, src) of every pair of id-list rows."""
    d = lists.select(encode_id(F.col("id")).alias("i"), F.explode("ids").alias("c"))
    return d.select("i", encode_id(F.col("c")).alias("j"), F.substring("c", 2, 1).cast("int").alias("src"))


def write_id_lists(ids: DataFrame, lists: DataFrame, path: str, column: str = "matched_entity_ids") -> None:
    """ids: pos, id in file order (repeats are written once, at their first place); lists: id, ids (array).
    One file, a row per id, its list without repeats and with ids of sources 2 and 3 only."""
    first = ids.groupBy("id").agg(F.min("pos").alias("pos"))
    kept = F.array_join(F.array_distinct(F.filter("ids", lambda x: x.rlike("^S[23]-"))), ",")
    rows = first.join(lists, "id", "left").select("pos", F.col("id").alias("source1_entity_id"), F.coalesce(kept, F.lit("")).alias(column))
    rows.orderBy("pos").drop("pos").coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_decisions(ids: DataFrame, scores: DataFrame, chosen: DataFrame, out: str) -> None:
    """Both files of a run: candidate lists by descending score and the chosen matches."""
    names = ids.select("pos", decode_id(F.col("i")).alias("id"))
    for name, column, rows in (("candidates", "candidate_entity_ids", scores), ("matches", "matched_entity_ids", chosen)):
        lists = rows.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("o"), "j"))), lambda x: decode_id(x["j"])).alias("ids"))
        write_id_lists(names, lists.select(decode_id(F.col("i")).alias("id"), "ids"), f"{out}/{name}", column)


def write_store(records: DataFrame, path: str) -> None:
    """Normalized records as zstd Parquet by country and source, so later scans read only what they need."""
    records.write.mode("overwrite").option("compression", "zstd").partitionBy("country", "src").parquet(path)


def read_store(spark: SparkSession, path: str, src: Iterable[int] = (1, 2, 3), columns: list[str] | None = None) -> DataFrame:
    d = spark.read.parquet(path).where(F.col("src").isin(*src))
    return d.select(columns) if columns else d


def stage(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at path, made and written first unless a finished one is there."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def pair_texts(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """pairs: i, j and more, with both records' text "name ; address", spaces squeezed."""
    text = F.trim(F.regexp_replace(F.concat_ws(" ; ", "name_raw", "addr_raw"), r"\s+", " "))
    t = records.select("eid", text.alias("t"))
    return pairs.join(t.select(F.col("eid").alias("i"), F.col("t").alias("text_a")), "i").join(t.select(F.col("eid").alias("j"), F.col("t").alias("text_b")), "j")


def write_source(records: DataFrame, path: str) -> None:
    """records: eid, country, name_raw, addr_raw as a tab-separated source; cells must hold no tab or line end."""
    cells = [decode_id(F.col("eid")), "name_raw", "addr_raw", "country"]
    d = records.select(*(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).alias(n) for c, n in zip(cells, SOURCE)))
    d.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_table(table: DataFrame, path: str) -> None:
    """A small table, as importances and statistics are, as comma-separated values with a header."""
    table.write.mode("overwrite").option("header", True).csv(path)


def write_meta(spark: SparkSession, meta: dict, path: str) -> None:
    """What a run was made with, one JSON object a line."""
    spark.createDataFrame([(json.dumps(meta, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_ids(ids: DataFrame, path: str) -> None:
    """ids: i. Text ids, one a line, in ascending parts."""
    ids.select("i").distinct().orderBy("i").select(decode_id(F.col("i")).alias("value")).write.mode("overwrite").text(path)


def pair_export(pairs: DataFrame, records: DataFrame, low: float, high: float) -> DataFrame:
    """pairs: i, j, p and more: those with a score in the band, with both records' texts in ASCII."""
    band = pairs.where(F.col("p").between(low, high))
    return pair_texts(band, records.withColumns({c: transliterate(F.col(c), True) for c in ("name_raw", "addr_raw")}))


def markdown(rows: list[dict]) -> str:
    """A small result as a Markdown table."""
    if not rows:
        return ""
    head = list(rows[0])
    return "\n".join(["| " + " | ".join(head) + " |", "|" + " --- |" * len(head), *("| " + " | ".join(str(r[c]) for c in head) + " |" for r in rows)])


def as_json(rows: list[dict]) -> str:
    return json.dumps(rows, indent=1, sort_keys=True, default=str)
