"""Near-duplicate documents: SetSketch registers, banded, judged by likelihood, confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, binaries, int64, mix, pieces, table, texts
from .components import connected
from .near import BLOCK, hashed_bands, likely_jaccard, near_components

_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))


@dataclass(frozen=True)
class Sketch:
    """registers (a power of two) of base `base`; `rows` registers make a band. With 128 registers in
    32 bands of 4 a pair of similarity 0.75 shares no band once in 190,000 cases. A candidate is
    dropped only if the likelihood of every linking similarity is e^-lost of the best."""

    words: int = 5
    threshold: tuple[int, int] = (75, 100)
    registers: int = 128
    rows: int = 4
    base: float = 1.001
    rate: float = 32.0
    lost: float = 30.0
    block: int = BLOCK


class _Words(dict):
    """The hash of each word, kept while there are fewer than a million."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_sets(docs: list[bytes], words: int, known: _Words) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its word n-grams; of a shorter text one, of its whole sequence."""
    out = []
    k = np.uint64(0x9E3779B97F4A7C15)
    for text in docs:
        tokens = text.translate(_LOWER).split()
        n = len(tokens)
        if not n:
            out.append(np.empty(0, np.uint64))
            continue
        w = np.fromiter(map(known.__getitem__, tokens), np.uint64, n)
        width = min(n, words)
        h = w[: n - width + 1].copy()
        for x in range(1, width):
            h *= k
            h += w[x : n - width + 1 + x]
        h = mix(h + np.uint64(width))
        h.sort()
        out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
    return out


def sketches(sets: list[np.ndarray], sketch: Sketch) -> np.ndarray:
    """SetSketch registers of each set, as uint16 rows.

    Every element throws the points of a Poisson process of rate 1 on each register. Points come in
    ascending order from the element's hash alone, so only those below a bound that all registers
    reach are made: about registers * (ln registers + 6) for a set of any size. A set with a register
    left empty is done again with twice the bound, so registers never depend on it: they are minima,
    and the sketch of a union is the maximum of the registers.
    """
    m = sketch.registers
    out = np.zeros((len(sets), m), np.uint16)
    todo = [i for i, s in enumerate(sets) if len(s)]
    reach = np.log(m) + 6
    while todo:
        sizes = np.array([len(sets[i]) for i in todo])
        least = np.full(len(todo) * m, np.inf)
        h = np.concatenate([sets[i] for i in todo])
        slot = np.repeat(np.arange(len(todo)), sizes) * m
        bound = np.repeat(reach / sizes, sizes)
        x = np.zeros(len(h))
        k, width = 0, 1
        while len(h):
            steps = np.arange(k + 1, k + 1 + width, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            z = mix(h[:, None] + steps[None, :])
            gaps = -np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
            points = np.cumsum(gaps, axis=1) + x[:, None]
            ok = points <= bound[:, None]
            np.minimum.at(least, (slot[:, None] + (z & np.uint64(m - 1)).astype(np.int64))[ok], points[ok])
            go = ok[:, -1]
            h, slot, bound, x = h[go], slot[go], bound[go], points[go, -1]
            k += width
            width = min(max(1, k), 64)
        least = least.reshape(-1, m)
        full = np.isfinite(least).all(1)
        values = np.floor(1 - np.log(least[full] / sketch.rate) / np.log(sketch.base))
        done = np.array(todo)[full]
        out[done] = np.clip(values, 0, 65535).astype(np.uint16)
        todo = np.array(todo)[~full].tolist()
        reach *= 2
    return out


def minhash_dedup(spark: SparkSession, docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """docs: doc_id (long), text. One row per input row: doc_id, n_shingles, component_id, kept.

    Documents link when 100 * |A and B| >= 75 * |A or B| on their distinct 5-word shingles;
    component_id is the smallest doc_id that links reach, kept says that it is the row's own.
    Equal sets meet by a 128-bit fingerprint, so copies cost one row each; near ones by SetSketch
    bands (see near.py), the likelihood screen, then the full sets.
    Nulls: a null text has no words and links with nothing; a row with null doc_id is kept, takes
    no part, and its component_id is null. Repeated rows: rows of one doc_id are one node, whatever their
    texts, all kept if it is kept; one of them without words is its own component. Ties: of equal sets the
    smallest doc_id names the class. Very long texts are one task's memory, some 40 bytes a word.
    Sets are equal when their 128-bit fingerprints are, shingles when their 64-bit hashes are.
    Empty input gives no rows. Other columns are ignored, whatever their names.
    """
    work = Work(spark, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch, sets in ((b.slice(at, len(part)), shingle_sets(part, sketch.words, known)) for b in batches for at, part in pieces(texts(b.column(1)))):
            prints = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
            keys = hashed_bands(sketches(sets, sketch), sketch.rows)
            ends = np.arange(len(sets) + 1) * keys.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), int64([len(s) for s in sets]), int64(prints[:, 0]), int64(prints[:, 1]), binaries(keys.reshape(-1), ends)], ["doc_id", "n_shingles", "f1", "f2", "keys"])

    seen = work.save(docs.mapInArrow(profile, "doc_id long, n_shingles long, f1 long, f2 long, keys binary"), "profile")
    whole = ["n_shingles", "f1", "f2"]
    same = work.save(seen.where("n_shingles > 0 and doc_id is not null").groupBy(*whole).agg(F.min("doc_id").alias("id")), "same")
    firsts = work.save(seen.join(same.withColumnRenamed("id", "doc_id"), [*whole, "doc_id"], "left_semi").select(F.col("doc_id").alias("id"), "keys"), "firsts")

    def fetch(placed: DataFrame) -> DataFrame:
        return placed.hint("merge").join(docs.withColumnRenamed("doc_id", "id"), "id").select("id", "grp", "nb", "blk", "text")

    def measure(found: list[bytes]) -> tuple:
        sets = shingle_sets(found, sketch.words, _Words())
        return sets, sketches(sets, sketch)

    num, den = sketch.threshold
    screen = likely_jaccard(sketch.base, num / den, sketch.lost)
    near = near_components(spark, work, firsts, firsts.count(), sketch.registers // sketch.rows, fetch, measure, screen, sketch.threshold, sketch.block, lambda found: shingle_sets(found, sketch.words, _Words()))
    # Rows of one doc_id with different sets belong to several classes, which that document joins.
    own = seen.where("n_shingles > 0 and doc_id is not null").select("doc_id", F.struct(*whole).alias("class"))
    several = own.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("doc_id")
    several = work.save(several, "several")
    if not several.isEmpty():
        through = own.join(several, "doc_id", "left_semi").select("doc_id", "class.*").join(same, whole).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
        near = connected(work, work.save(through, "through").unionByName(near.select(F.col("id").alias("a"), F.col("comp").alias("b"))), "repeated")
    named = work.save(same.join(near, "id", "left").select(*whole, F.coalesce("comp", "id").alias("comp")), "named")
    work.clear("profile", "named")
    linked = seen.select("doc_id", *whole).join(named, whole, "left")
    out = linked.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(spark, table(spark, sf_dir, "documents"))


OP1_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda z: z <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
lowest AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN lowest ON x = d.doc_id"""
