"""Linkage input made from the driver's tables, the same way in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ID_BASE

SPACE = "[ \t\n\f\r]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources by doc_id; the first six words are the name, the last eight the address, lang the country."""
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", F.filter(F.split("text", SPACE), lambda w: w != "").alias("w"))
    src = (1 + F.col("doc_id") % 3).cast("int")
    address = F.slice("w", F.greatest(F.size("w") - 7, F.lit(1)), 8)
    return d.select((src.cast("long") * ID_BASE + F.col("doc_id")).alias("eid"), src.alias("src"), F.col("lang").alias("country"), F.array_join(F.slice("w", 1, 6), " ").alias("name_raw"), F.array_join(address, " ").alias("addr_raw"))


def from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records rich in numbers: the part's name, and brand, type, size and key as its address."""
    p = load(spark, sf_dir, "part")
    src = (1 + F.col("p_partkey") % 3).cast("int")
    address = F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type"), F.lit(", "), F.col("p_size").cast("string"), F.lit("th St. "), (F.col("p_partkey") % 97).cast("string"), F.lit("b Rd & 00"), (F.col("p_partkey") % 1000).cast("string"))
    name = F.concat(F.col("p_name"), F.lit(" Pvt. Ltd. aka The "), F.col("p_brand"), F.lit(" Co"))
    return p.select((src.cast("long") * ID_BASE + F.col("p_partkey")).alias("eid"), src.alias("src"), F.substring("p_brand", 1, 7).alias("country"), name.alias("name_raw"), address.alias("addr_raw"))


DOCUMENTS_SQL = """rec AS (
  SELECT CAST(1 + doc_id % 3 AS INTEGER) AS src, (1 + doc_id % 3) * 1000000000000 + doc_id AS eid, lang AS country,
    array_to_string(list_slice(w, 1, 6), ' ') AS name_raw,
    array_to_string(list_slice(w, greatest(len(w) - 7, 1), len(w)), ' ') AS addr_raw
  FROM (SELECT doc_id, lang, list_filter(regexp_split_to_array(text, '[ \\t\\n\\f\\r]+'), lambda x: x <> '') AS w FROM documents))"""

PARTS_SQL = """rec AS (
  SELECT CAST(1 + p_partkey % 3 AS INTEGER) AS src, (1 + p_partkey % 3) * 1000000000000 + p_partkey AS eid, substr(p_brand, 1, 7) AS country,
    p_name || ' Pvt. Ltd. aka The ' || p_brand || ' Co' AS name_raw,
    p_brand || ' ' || p_type || ', ' || p_size || 'th St. ' || (p_partkey % 97) || 'b Rd & 00' || (p_partkey % 1000) AS addr_raw
  FROM part)"""
