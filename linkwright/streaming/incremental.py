"""New source 2 and 3 records linked to a fixed source 1 as a stream brings them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.blocking import FAMILIES, Blocking, record_keys
from ..operators.normalize import normalize


def asking_keys(spark_records: DataFrame, config: Blocking = Blocking()) -> DataFrame:
    """(country, fam, key, i, w): source 1's keys, each weighted by its rarity among source 1, those over
    their cap left out. Made once, before the stream starts."""
    keys = record_keys(spark_records.where("src = 1"), config)
    n = spark_records.where("src = 1").groupBy("country").agg(F.count("*").alias("n"))
    caps = F.create_map(*(F.lit(x) for f, (_, c) in FAMILIES.items() for x in (f, config.cap if config.cap is not None else c)))
    df = keys.groupBy("country", "fam", "key").agg(F.count("*").alias("df")).where(F.col("df") <= F.try_element_at(caps, F.col("fam")))
    weights = df.join(n, "country").select("country", "fam", "key", F.round(F.log("n") - F.log("df"), 9).alias("w"))
    return keys.join(weights, ["country", "fam", "key"]).select("country", "fam", "key", F.col("eid").alias("i"), "w")


def link_batch(batch: DataFrame, asking: DataFrame, config: Blocking = Blocking(), top: int = 5) -> DataFrame:
    """Of each new record (eid, src, country, name_raw, addr_raw) the best owners: j, i, score. Its rare
    tokens are those of the batch; the weights are source 1's."""
    keys = record_keys(normalize(batch), config).select("country", "fam", "key", F.col("eid").alias("j"))
    hits = keys.join(asking, ["country", "fam", "key"]).groupBy("j", "i").agg(F.round(F.sum("w"), 6).alias("score"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), "i", "score"))), 1, top)
    return hits.groupBy("j").agg(best.alias("b")).select("j", F.explode("b").alias("b")).select("j", "b.i", "b.score")


def link_stream(stream: DataFrame, asking: DataFrame, out: str, checkpoint: str, config: Blocking = Blocking(), top: int = 5) -> StreamingQuery:
    """Starts a query that writes each micro-batch's links to out/batch=<id>; a batch that is done again
    after a failure overwrites its own folder, so links are there once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        link_batch(batch, asking, config, top).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
