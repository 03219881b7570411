"""What the operators share: tables, the shared work folder, batches of text, and grouped Arrow maps."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import linkwright.llm as _package

#: Executors need no copy of the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(_package)

#: Bytes and rows of one Arrow batch sent to a Python worker; bounds its memory whatever the texts' length.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 4096

#: Bytes of text that are worked on at once.
PIECE = 1 << 20

_local_root: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes as well as rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Work:
    """A folder of its own below spark.checkpoint.dir, for tables that cut the lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str, codec: str = "snappy"):
        prepare(spark)
        self.spark, self.path, self.codec = spark, f"{self._root(spark)}/{name}-{uuid.uuid4().hex[:12]}", codec

    @staticmethod
    def _root(spark: SparkSession) -> str:
        if at := spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None):
            return at.rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        if not _local_root:
            _local_root.append("file://" + tempfile.mkdtemp(prefix="linkwright-"))
        return _local_root[0]

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back: later readers start from files."""
        df.write.mode("overwrite").option("compression", self.codec).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def bucket(self, df: DataFrame, name: str, key: str, n: int) -> DataFrame:
        """Write df dealt by key into n sorted buckets: tables of equally many join on it without a shuffle.

        The catalog forgets the table at once; what is returned reads its files with their buckets.
        """
        known = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
        if n > int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets")):
            self.spark.conf.set("spark.sql.sources.bucketing.maxBuckets", str(n))
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("compression", self.codec).option("path", f"{self.path}/{name}").saveAsTable(known)
        out = self.spark.table(known)
        self.spark.sql(f"DROP TABLE {known}")
        return out

    def tidy(self) -> None:
        """Let go of the shuffle files of plans that nothing refers to any more; Spark does so some
        moments after the driver has collected them, hence the short waits."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def clear(self, *kept: str) -> None:
        """Delete the tables of this folder but those named, which are all that is read from now on, and let
        go of the shuffle files they were made from."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for at in found.listStatus(path):
            if at.getPath().getName() not in kept:
                found.delete(at.getPath(), True)
        self.tidy()


# ---------------------------------------------------------------- text batches


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(found: list[bytes], size: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of the texts of about this many bytes, each with the place of its first: what is made of a
    run at once stays small however long the texts of a batch are."""
    at = total = 0
    for i, x in enumerate(found):
        total += len(x)
        if total >= size:
            yield at, found[at : i + 1]
            at, total = i + 1, 0
    if at < len(found):
        yield at, found[at:]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# ---------------------------------------------------------------- grouped maps


def by_group(df: DataFrame, keys: list[str], function: Callable[..., Iterator[pa.RecordBatch]], schema: str, prepare: Callable[[pa.RecordBatch], tuple] | None = None) -> DataFrame:
    """function over all rows of each key. Callers bound the groups; one that spans batches is put together.

    prepare makes a tuple of sequences, a value per row, from a whole batch at once, which costs small
    groups less; function then gets the group's share of them as a second argument, in pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        pieces: list[tuple] = []
        current = None

        def close() -> Iterator[pa.RecordBatch]:
            group = pa.Table.from_batches(held)
            return function(group) if prepare is None else function(group, pieces)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            made = prepare(batch) if prepare else ()
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(n, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            starts = np.concatenate([[0], np.nonzero(change)[0], [n]])
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                key = tuple(c[lo] for c in columns)
                if held and key != current:
                    yield from close()
                    held, pieces = [], []
                current = key
                held.append(batch.slice(lo, hi - lo))
                pieces.append(tuple(x[lo:hi] for x in made))
        if held:
            yield from close()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose i-th value is the bytes of data[offsets[i]:offsets[i + 1]], without a copy."""
    width = data.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray((np.asarray(offsets) * width).astype(np.int32))), pa.py_buffer(np.ascontiguousarray(data))])


def int64(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64), pa.int64())
