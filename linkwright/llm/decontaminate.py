"""Benchmark decontamination by a stored positional inverted index of the training documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, by_group, int64, table, texts
from .minhash import _Words

#: A-Z to a-z; digits, a-z and every byte of a non-ASCII character stay; the rest separates words.
_WORD_BYTES = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x > 127 else 32 for x in range(256))


@dataclass(frozen=True)
class Match:
    """window: consecutive item words that make a hit. block: words of one stored index block. chunk:
    windows that are sent to the tasks at once; a larger benchmark is searched chunk after chunk.
    slop: when given, also report where all of a window's words lie within slop words more than it has."""

    window: int = 10
    block: int = 1 << 19
    chunk: int = 200_000
    slop: int | None = None


def tokens(text: bytes, known: _Words) -> np.ndarray:
    found = text.translate(_WORD_BYTES).split()
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def build_index(docs: DataFrame, config: Match) -> DataFrame:
    """docs: doc_id, text. One row per block of documents: the words' positions sorted by word.

    terms: sorted distinct word hashes; ends: where each one's positions end; positions: word
    positions in the block, a window's length apart between documents, so that no phrase crosses
    two; doc_ids, nulls, starts, sizes: of its documents. Blocks never depend on one another.
    """
    gap = config.window + (config.slop or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, k = _Words(), TaskContext.get().partitionId(), 0

        def block(held: list[tuple[object, np.ndarray]]) -> pa.RecordBatch:
            sizes = np.array([len(w) for _, w in held], np.int32)
            starts = np.concatenate([[0], np.cumsum(sizes + gap)[:-1]]).astype(np.int32)
            words = np.concatenate([w for _, w in held])
            where = np.arange(len(words), dtype=np.int32) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes).astype(np.int32)
            order = np.argsort(words, kind="stable")
            words, where = words[order], where[order]
            cut = np.nonzero(words[1:] != words[:-1])[0] + 1
            ends = np.concatenate([cut, [len(words)]]).astype(np.int32) if len(words) else np.empty(0, np.int32)
            terms = words[ends - 1] if len(words) else words
            ids = np.array([d if d is not None else 0 for d, _ in held], np.int64)
            nulls = np.array([d is None for d, _ in held], np.uint8)
            cells = [int64([task << 32 | k]), *(pa.array([x.tobytes()], pa.binary()) for x in (terms, ends, where, ids, nulls, starts, sizes))]
            return pa.RecordBatch.from_arrays(cells, ["block", "terms", "ends", "positions", "doc_ids", "nulls", "starts", "sizes"])

        held, n = [], 0
        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                held.append((d, tokens(text, known)))
                n += len(held[-1][1]) + gap
                if n >= config.block:
                    yield block(held)
                    held, n, k = [], 0, k + 1
        if held:
            yield block(held)

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(run, "block long, terms binary, ends binary, positions binary, doc_ids binary, nulls binary, starts binary, sizes binary")


def item_windows(benchmark: DataFrame, config: Match) -> DataFrame:
    """benchmark: item_id, text. (item_id, terms): each item's distinct windows, as word hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            items, windows = [], []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                w = tokens(text, known)
                for found in {w[i : i + config.window].tobytes() for i in range(max(len(w) - config.window + 1, 1))} if len(w) else ():
                    items.append(item)
                    windows.append(found)
            yield pa.RecordBatch.from_arrays([int64(items), pa.array(windows, pa.binary())], ["item_id", "terms"])

    known_items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null")
    return known_items.mapInArrow(run, "item_id long, terms binary").distinct()


def _phrases(lookup, low, high, rank, lengths) -> tuple[np.ndarray, np.ndarray]:
    """Exact matches as (window, start). lookup: sorted rank << 32 | position; low, high: of each word
    of each window the range of its list. From the rarest word on, each list shifted by the word's
    place is intersected with what is left."""
    width = rank.shape[1]
    counts = np.where(np.arange(width)[None, :] < lengths[:, None], high - low, np.iinfo(np.int64).max)
    by_rarity = np.argsort(counts, axis=1, kind="stable")
    rows = np.arange(len(lengths))
    rarest = by_rarity[:, 0]
    n = counts[rows, rarest]
    window = np.repeat(rows, n)
    first = np.repeat(low[rows, rarest] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    start = (lookup[first] & 0xFFFFFFFF) - rarest[window]
    window, start = window[start >= 0], start[start >= 0]
    for step in range(1, width):
        if not len(window):
            break
        place = by_rarity[window, step]
        sought = (rank[window, place].astype(np.int64) << 32) + start + place
        at = np.minimum(np.searchsorted(lookup, sought), len(lookup) - 1)
        ok = (lookup[at] == sought) | (step >= lengths[window])
        window, start = window[ok], start[ok]
    return window, start


def _nearby(lookup, low, high, rank, lengths, slop: int) -> np.ndarray:
    """Proximity matches as sorted rows (window, start): all words of the window within as many words from
    start, the place of one of them, as it has, and slop. From the rarest word's places on, those are left that have each
    other word less than that away; only around them are starts tried."""
    width, spans = rank.shape[1], lengths + slop
    counts = np.where(np.arange(width)[None, :] < lengths[:, None], high - low, np.iinfo(np.int64).max)
    by_rarity = np.argsort(counts, axis=1, kind="stable")
    rows = np.arange(len(lengths))
    n = counts[rows, by_rarity[:, 0]]
    window = np.repeat(rows, n)
    place = lookup[np.repeat(low[rows, by_rarity[:, 0]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] & 0xFFFFFFFF
    for step in range(1, width):
        if not len(window):
            break
        term, span = by_rarity[window, step], spans[window]
        least = np.maximum(place - span + 1, 0)
        sought = (rank[window, term].astype(np.int64) << 32) + least
        at = np.minimum(np.searchsorted(lookup, sought), len(lookup) - 1)
        ok = ((lookup[at] >= sought) & (lookup[at] < sought - least + place + span)) | (step >= lengths[window])
        window, place = window[ok], place[ok]
    found = set()
    for w, p, span in zip(window.tolist(), place.tolist(), spans[window].tolist()):
        # The places of the window's words around this one of its rarest word, in order.
        near = sorted({(int(x), int(r)) for r, a, b in zip(rank[w, : lengths[w]], low[w], high[w]) for x in lookup[a:b][slice(*np.searchsorted(lookup[a:b] & 0xFFFFFFFF, [p - span + 1, p + span]))] & 0xFFFFFFFF})
        terms = len(set(rank[w, : lengths[w]].tolist()))
        for i, (start, _) in enumerate(near):
            if start <= p and len({r for x, r in near[i:] if x < start + span}) == terms:
                found.add((w, start))
    return np.array(sorted(found), np.int64).reshape(-1, 2)


def search(index: DataFrame, windows: list[bytes], items: list[list[int]], config: Match) -> DataFrame:
    """Each indexed document's hits by these windows (items: the items that hold each one): doc_id,
    n_words, starts and ends of the merged hit spans in words, items, near_items."""
    width = config.window
    lengths = np.array([len(w) // 8 for w in windows], np.int64)
    terms = np.zeros((len(windows), width), np.uint64)
    for i, w in enumerate(windows):
        terms[i, : lengths[i]] = np.frombuffer(w, np.uint64)
    inside = np.arange(width)[None, :] < lengths[:, None]
    slop = config.slop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vocabulary, ends = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["ends"], np.int32).astype(np.int64)
                starts, sizes = np.frombuffer(row["starts"], np.int32), np.frombuffer(row["sizes"], np.int32)
                ids, nulls = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["nulls"], np.uint8)
                spans: dict[int, list] = {}
                found: dict[int, set] = {}
                near: dict[int, set] = {}
                if len(vocabulary) and len(windows):
                    at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                    use = np.nonzero(((vocabulary[at] == terms) | ~inside).all(1))[0]
                    if len(use):
                        high, rank = ends[at[use]], at[use]
                        low = np.where(rank > 0, ends[rank - 1], 0)
                        lookup = (np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends]))) << 32) + np.frombuffer(row["positions"], np.int32)
                        w, s = _phrases(lookup, low, high, rank, lengths[use])
                        doc = np.searchsorted(starts, s, side="right") - 1
                        for d, first, which in zip(doc.tolist(), (s - starts[doc]).tolist(), use[w].tolist(), strict=True):
                            spans.setdefault(d, []).append((first, first + int(lengths[which])))
                            found.setdefault(d, set()).update(items[which])
                        if slop is not None:
                            w, s = _nearby(lookup, low, high, rank, lengths[use], slop).T
                            for d, which in zip((np.searchsorted(starts, s, side="right") - 1).tolist(), use[w].tolist(), strict=True):
                                near.setdefault(d, set()).update(items[which])
                merged = [_merge(spans.get(d, [])) for d in range(len(ids))]
                cells = [
                    int64(np.full(len(ids), row["block"])), int64(np.arange(len(ids))), pa.array(ids, mask=nulls.astype(bool)), int64(sizes),
                    pa.array([[x for x, _ in m] for m in merged], pa.list_(pa.int64())), pa.array([[x for _, x in m] for m in merged], pa.list_(pa.int64())),
                    *(pa.array([sorted(x.get(d, ()), key=str) for d in range(len(ids))], pa.list_(pa.int64())) for x in (found, near)),
                ]
                yield pa.RecordBatch.from_arrays(cells, ["block", "row", "doc_id", "n_words", "starts", "ends", "items", "near_items"])

    return index.mapInArrow(run, "block long, row long, doc_id long, n_words long, starts array<long>, ends array<long>, items array<long>, near_items array<long>")


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, config: Match = Match()) -> DataFrame:
    """docs: doc_id, text; benchmark: item_id, text. One row per document: doc_id, n_words, starts and
    ends (merged hit spans, in words), items (ids of items with an occurring window, sorted as
    strings) and near_items (by proximity; empty unless slop is given).

    Nulls: a null text has no words; a document with null doc_id is searched like any other; an item
    with null item_id is ignored. An item without words has no window, one shorter than a window is
    one window. Repeated rows: each gets its own row of the result; repeated items count once. Empty
    tables: no documents give no rows, no items no hits. Other columns are ignored.
    """
    work = Work(spark, "index")
    index = work.save(build_index(docs, config), "blocks")
    windows = work.save(item_windows(benchmark, config), "windows")
    chunks = max(1, -(-windows.count() // config.chunk))
    windows = windows.withColumn("chunk", F.pmod(F.xxhash64("terms"), F.lit(chunks)))

    def one(c: int) -> DataFrame:
        by: dict[bytes, list[int]] = {}
        for item, terms in windows.where(F.col("chunk") == c).select("item_id", "terms").toLocalIterator():
            by.setdefault(bytes(terms), []).append(item)
        return search(index, list(by), list(by.values()), config)

    columns = ["doc_id", "n_words", "starts", "ends", "items", "near_items"]
    if chunks == 1:
        return one(0).select(columns)
    found = None
    for c in range(chunks):
        part = one(c)
        part = work.save(part if c == 0 else part.where("size(items) > 0 or size(near_items) > 0"), f"found-{c}")
        found = part if found is None else found.unionByName(part)

    def together(group: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = group.to_pylist()
        spans = _merge([x for r in rows for x in zip(r["starts"], r["ends"], strict=True)])
        out = rows[0] | {"starts": [a for a, _ in spans], "ends": [b for _, b in spans]}
        out |= {k: sorted({x for r in rows for x in r[k]}, key=str) for k in ("items", "near_items")}
        yield pa.RecordBatch.from_pylist([out], schema=group.schema)

    return by_group(found, ["block", "row"], together, found.schema.simpleString()[7:-1].replace(":", " ", 8)).select(columns)


#: Words more than a window's that the query's proximity matches may be spread over.
SLOP = 4


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Match(slop=SLOP))
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.col("items").cast("array<string>")), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near"))


_LOWERED = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_LOWERED}, []) AS w FROM documents),
b AS (SELECT item_id, {_LOWERED} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
i AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda k: array_to_string(w[k:k + 9], ' '))) AS g FROM b WHERE len(w) > 0),
e AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS k, w FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n),
h AS (SELECT e.r, e.k, e.n, i.item_id FROM e JOIN i ON i.n = e.n AND i.g = array_to_string(e.w[e.k:e.k + e.n - 1], ' ')),
p AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS q FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS l FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r),
o AS (SELECT r, w, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d),
wi AS (SELECT DISTINCT item_id, n, list_distinct(list_sort(string_split(g, ' '))) AS s FROM i),
wd AS (SELECT row_number() OVER () AS q, n, s FROM (SELECT DISTINCT n, s FROM wi)),
df AS (SELECT x, count(*) AS c FROM o GROUP BY x),
wx AS (SELECT q, n, s, unnest(s) AS x FROM wd),
ra AS (SELECT q, n, s, arg_min(x, (coalesce(c, 0), x)) AS x FROM wx LEFT JOIN df USING (x) GROUP BY q, n, s),
st AS (SELECT DISTINCT r, q, n, s, w, unnest(range(greatest(k - n - {SLOP} + 1, 1), k + 1)) AS k FROM o JOIN ra USING (x)),
nw AS (SELECT DISTINCT r, q FROM st WHERE list_has_all(w[k:k + n + {SLOP} - 1], s)),
nn AS (SELECT r, count(DISTINCT item_id) AS n_near FROM nw JOIN wd USING (q) JOIN wi ON wi.n = wd.n AND wi.s = wd.s GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r) LEFT JOIN nn USING (r)"""
