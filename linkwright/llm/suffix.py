"""Substring dedup: a difference cover's suffixes sorted bucket by bucket, all others resolved by their ranks.

Two equal windows have, whatever their places, a common shift below the cover's period at which both
lie on sampled places. So a window is equal to another if at that shift the bytes before the two samples
agree, fewer than a period, and the two sample suffixes rank alike to the depth that is left of the window.
Only sample suffixes are ever sorted, and of those only the ones that some other document may share:

1. Sample strings that one document alone has are told by a fingerprint of their first `width - period + 1`
   bytes; none of their windows can be equal to another's. False agreements only cost work.
2. The others are sorted by their bytes to the window's depth, one bucket of equal first bytes at a time.
   Ranks at each depth follow from the common prefixes of neighbours; classes of the bytes before them from
   sorting those. Of equal windows all but the smallest document's are marked, a bit for each shift.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, binaries, by_group, int64, mix, partitions, table, texts

#: Difference covers, fixed values: every remainder modulo the period is a difference of two of them.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}


@dataclass(frozen=True)
class Suffixes:
    """width: bytes of a repeated string. period: of the cover, below width and 32. rounds: suffix buckets
    that are sorted one after the other. chunk: bytes of the documents that travel together; a longer
    text is dealt to several. run: suffixes that one task sorts, in mean. bucket: bytes of text whose
    answers one task puts together."""

    width: int = 50
    period: int = 21
    rounds: int = 4
    chunk: int = 2 << 20
    run: int = 1 << 19
    bucket: int = 32 << 20

    @property
    def side(self) -> int:
        """Bytes before a sample that a window may begin with."""
        return self.period - 1

    @property
    def mid(self) -> int:
        """Bytes from a sample on that every window over it has."""
        return self.width - self.side


_MULTIPLIER = 0x9E3779B97F4A7C15
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers and their inverses modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x, np.uint64))]) for x in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


def fingerprints(data: np.ndarray, at: np.ndarray, width: int, step: int = 1 << 19) -> np.ndarray:
    """64-bit fingerprints of the strings of this width from the ascending places on."""
    keys = np.empty(len(at), np.uint64)
    for lo in range(0, len(data), step):
        a, b = np.searchsorted(at, [lo, lo + step])
        if a == b:
            continue
        part = data[lo : lo + step + width]
        up, down = _power(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LETTERS[part] * up, out=total[1:])
        here = at[a:b] - lo
        keys[a:b] = mix((total[here + width] - total[here]) * down[here])
    return keys


# ---------------------------------------------------------------- chunks of documents

PACK = "chunk long, doc_ids binary, sizes binary, data binary, lead long, own long, at long, row long"


def pack(docs: DataFrame, config: Suffixes) -> DataFrame:
    """docs: doc_id, text. Rows of many documents each: chunk, doc_ids, sizes, data (texts end to end).

    A text beyond `chunk` bytes is dealt to rows of its own: data begins at byte `at` of the text, of it
    `own` bytes after `lead` belong to the row, the others are what its samples see before and after.
    Places of all rows of a text agree modulo the period. row tells the text, -1 where texts are whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0

        def row(held: list[tuple[int, bytes]], lead: int = 0, own: int | None = None, at: int = 0, text: int = -1) -> pa.RecordBatch:
            nonlocal k
            held = sorted(held, key=lambda x: x[0])
            ids, sizes, data = np.array([d for d, _ in held], np.int64), np.array([len(t) for _, t in held], np.int64), b"".join(t for _, t in held)
            cells = [int64([task << 32 | k]), *(pa.array([x], pa.binary()) for x in (ids.tobytes(), sizes.tobytes(), data)), *(int64([x]) for x in (lead, len(data) if own is None else own, at, text))]
            k += 1
            return pa.RecordBatch.from_arrays(cells, ["chunk", "doc_ids", "sizes", "data", "lead", "own", "at", "row"])

        held, size = [], 0
        step = max(config.chunk // config.period, 1) * config.period
        for batch in batches:
            for d, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                if len(text) > config.chunk:
                    name = task << 32 | k
                    for a in range(0, len(text), step):
                        lead = min(a, config.period)
                        yield row([(d, text[a - lead : a + step + config.width])], lead, min(step, len(text) - a), a - lead, name)
                    continue
                held.append((d, text))
                size += len(text)
                if size >= config.chunk:
                    yield row(held)
                    held, size = [], 0
        if held:
            yield row(held)

    return docs.mapInArrow(run, PACK)


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, sizes, data) of a packed row."""
    return np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["data"], np.uint8)


def _owners(at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of ascending places the index of the document that holds each."""
    cut = np.searchsorted(at, ends)
    return np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], cut])))


def cover_places(row: dict, config: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, document) of the row's own samples. Places are counted in the row: a cover meets whatever
    the two offsets are."""
    _, sizes, data = _open(row)
    ends = np.cumsum(sizes)
    at = (np.arange(0, len(data), config.period)[:, None] + np.array(COVERS[config.period])[None, :]).reshape(-1)
    at = at[np.searchsorted(at, row["lead"]) : np.searchsorted(at, row["lead"] + row["own"])]
    owner = _owners(at, ends)
    ok = at + config.mid <= ends[owner]
    return at[ok], owner[ok]


def contexts(row: dict, at: np.ndarray, owner: np.ndarray, config: Suffixes) -> np.ndarray:
    """What decides over the windows of each sample, a row of bytes: the window's width from it on, the
    bytes before it backwards, and how many of those and of the last `side` ones are the document's;
    the others are 0."""
    _, sizes, data = _open(row)
    ends, side, width = np.cumsum(sizes), config.side, config.width
    padded = np.concatenate([np.zeros(side, np.uint8), data, np.zeros(width, np.uint8)])
    out = np.empty((len(at), width + side + 2), np.uint8)
    out[:, :width] = np.lib.stride_tricks.sliding_window_view(padded, width)[at + side]
    out[:, width : width + side] = np.lib.stride_tricks.sliding_window_view(padded, side)[at][:, ::-1]
    before = np.minimum(at - (ends - sizes)[owner], side)
    after = np.minimum(ends[owner] - at - config.mid, side)
    short = np.nonzero(before < side)[0]
    out[short, width : width + side] *= np.arange(side)[None, :] < before[short, None]
    short = np.nonzero(after < side)[0]
    out[short, :width] *= np.arange(width)[None, :] < config.mid + after[short, None]
    out[:, -2], out[:, -1] = before, after
    return out


# ---------------------------------------------------------------- order, ranks and marks


def _in_order(rows: np.ndarray) -> np.ndarray:
    """The order of equally long strings of bytes."""
    return np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").reshape(-1), kind="stable")


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the next."""
    out = np.empty(max(len(rows) - 1, 0), np.int32)
    for lo in range(0, len(out), 1 << 16):
        differ = rows[lo + 1 : lo + 1 + (1 << 16)] != rows[lo : lo + (1 << 16)][: len(rows) - 1 - lo]
        out[lo : lo + len(differ)] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def _least(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The smallest document of those with the same key."""
    order = np.argsort(keys, kind="stable")
    first = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    out = np.empty(len(keys), np.int64)
    out[order] = np.minimum.reduceat(docs[order], np.nonzero(first)[0])[np.cumsum(first) - 1]
    return out


def same_contexts(rows: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, class of each in that order, where classes begin, their smallest document, common
    prefixes of neighbours) of the rows by their bytes."""
    order = _in_order(rows)
    common = _common(rows[order])
    new = np.concatenate([[True], common < rows.shape[1]])
    first = np.nonzero(new)[0]
    return order, np.cumsum(new) - 1, first, np.minimum.reduceat(docs[order], first), common


def _every_shift(rows: np.ndarray, config: Suffixes) -> np.ndarray:
    """The shifts whose window lies within the document, as bits."""
    shifts = np.arange(config.period)
    ok = (shifts <= rows[:, -2:-1]) & (config.side - shifts <= rows[:, -1:])
    return (ok.astype(np.int32) << shifts.astype(np.int32)).sum(1, dtype=np.int32)


def marks(rows: np.ndarray, docs: np.ndarray, config: Suffixes) -> np.ndarray:
    """rows: contexts of a bucket's samples; docs: their documents. The shifts, as bits, at which the
    window that begins so many bytes before the sample also begins in a smaller document."""
    width, side = config.width, config.side
    order, kind, first, low, common = same_contexts(rows, docs)
    each = rows[order[first]]
    bounds = common[first[1:] - 1]
    every = _every_shift(each, config)
    found = np.zeros(len(first), np.int32)
    group = np.concatenate([[0], np.cumsum(bounds < config.mid)])
    several = np.nonzero(np.bincount(group)[group] > 1)[0]
    if len(several):
        # The bytes before the samples, sorted within what agrees from the sample on.
        before = np.concatenate([group[several].astype(">u4").view(np.uint8).reshape(-1, 4), each[several, width : width + side]], 1)
        by = _in_order(before)
        common_before = _common(before[by]) - 4
        for shift in range(config.period):
            ranks = np.concatenate([[0], np.cumsum(bounds < width - shift)])[several]
            classes = np.empty(len(several), np.int64)
            classes[by] = np.concatenate([[0], np.cumsum(common_before < shift)])
            inside = np.nonzero(every[several] >> shift & 1)[0]
            if len(inside):
                docs_of = low[several[inside]]
                found[several[inside]] |= (docs_of > _least(ranks[inside] << 32 | classes[inside], docs_of)).astype(np.int32) << shift
    out = np.empty(len(rows), np.int32)
    out[order] = np.where(docs[order] > low[kind], every[kind], found[kind])
    return out


# ---------------------------------------------------------------- rounds

_SENT = "chunk long, part long, keys binary, docs binary, counts binary, places binary, known binary, codes binary"


def _sent(chunk: int, part: np.ndarray, keys: np.ndarray, docs: np.ndarray, places: np.ndarray, known: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    """A chunk's strings by the part that sorts them. What the chunk itself settled, known places and
    their codes, rides along with the first one: a code is an answer, or below 0 the place, less one
    and negative, whose answer it shares."""
    order = np.argsort(part, kind="stable")
    part, keys, docs, places = part[order], keys[order], docs[order], places[order].astype(np.int32)
    cut = np.concatenate([[0], np.nonzero(part[1:] != part[:-1])[0] + 1, [len(part)]])
    turns = np.nonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (part[1:] != part[:-1])]))[0]
    turn_cut = np.searchsorted(turns, cut)
    counts = np.diff(np.append(turns, len(docs))).astype(np.int32)
    own = np.zeros(len(cut), np.int64)
    own[1:] = len(known)
    parts = part[cut[:-1]]
    wide = cut * (keys.shape[1] if keys.ndim > 1 else 1)
    cells = [int64(np.full(len(parts), chunk)), int64(parts), binaries(keys.reshape(-1), wide), binaries(docs[turns], turn_cut), binaries(counts, turn_cut), binaries(places, cut), binaries(known.astype(np.int32), own), binaries(codes.astype(np.int32), own)]
    return pa.RecordBatch.from_arrays(cells, ["chunk", "part", "keys", "docs", "counts", "places", "known", "codes"])


def _sorted(sent: DataFrame, kind, answer) -> DataFrame:
    """(chunk, places, codes) by answer(keys, docs), 0 for none, of each part's strings."""

    def run(group: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = group.select(["chunk", "keys", "docs", "counts", "places", "known", "codes"]).to_pylist()
        docs = np.concatenate([np.repeat(np.frombuffer(x["docs"], np.int64), np.frombuffer(x["counts"], np.int32)) for x in rows])
        found = answer(kind(b"".join(x["keys"] for x in rows)), docs)
        cells = [], [], []
        for x, codes in zip(rows, np.split(found, np.cumsum([len(x["places"]) // 4 for x in rows])[:-1]), strict=True):
            places = np.concatenate([np.frombuffer(x["places"], np.int32)[codes != 0], np.frombuffer(x["known"], np.int32)])
            codes = np.concatenate([codes[codes != 0], np.frombuffer(x["codes"], np.int32)]).astype(np.int32)
            if len(places):
                order = np.argsort(places, kind="stable")
                for cell, value in zip(cells, (x["chunk"], np.diff(places[order], prepend=np.int32(0)).tobytes(), codes[order].tobytes()), strict=True):
                    cell.append(value)
        yield pa.RecordBatch.from_arrays([int64(cells[0]), *(pa.array(c, pa.binary()) for c in cells[1:])], ["chunk", "places", "codes"])

    return by_group(sent, ["part"], run, "chunk long, places binary, codes binary")


def _answered(packs: DataFrame, answers: DataFrame, how: str) -> DataFrame:
    """packs with their answers; only the answers move, for packs are bucketed by chunk."""
    by_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("places", "codes")).alias("answers"))
    return packs.join(by_chunk.hint("merge"), "chunk", how)


def _codes(row: dict) -> np.ndarray:
    """The answer for each place of a row's data."""
    out = np.zeros(len(row["data"]), np.int32)
    shared = []
    for x in row["answers"] or ():
        places, codes = np.cumsum(np.frombuffer(x["places"], np.int32)), np.frombuffer(x["codes"], np.int32)
        out[places[codes >= 0]] = codes[codes >= 0]
        shared.append((places[codes < 0], -1 - codes[codes < 0]))
    for places, of in shared:
        out[places] = out[of]
    return out


def _shared(spark: SparkSession, work: Work, packs: DataFrame, total: int, config: Suffixes) -> list[DataFrame]:
    """By round the samples whose first `mid` bytes may also be in another document, by fingerprint."""
    buckets = max(partitions(spark), -(-total // (config.rounds * 2 * config.run)))

    def send(r: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    at, owner = cover_places(row, config)
                    ids, _, data = _open(row)
                    keys = fingerprints(data, at, config.mid)
                    mine = keys % np.uint64(config.rounds) == r
                    keys, at, docs = keys[mine], at[mine], ids[owner[mine]]
                    if not len(at):
                        continue
                    order = np.lexsort([docs, keys])
                    keys, at, docs = keys[order], at[order], docs[order]
                    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
                    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
                    tied = (docs[np.append(first[1:], len(keys)) - 1] > docs[first])[group]
                    # One place of each string goes on; the others share its answer, or have theirs.
                    rest = np.ones(len(at), bool)
                    rest[first] = False
                    known = rest | tied
                    part = (keys[first] >> np.uint64(20)) % np.uint64(buckets)
                    yield _sent(row["chunk"], part.astype(np.int64), keys[first], docs[first], at[first], at[known], np.where(tied, 1, -1 - at[first][group])[known])

        return run

    def answer(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
        first, group = np.nonzero(new)[0], np.cumsum(new) - 1
        out = np.empty(len(keys), np.int32)
        out[order] = (np.maximum.reduceat(docs[order], first) > np.minimum.reduceat(docs[order], first))[group]
        return out

    found = []
    for r in range(config.rounds):
        sent = packs.mapInArrow(send(r), _SENT)
        found.append(work.save(_sorted(sent, lambda x: np.frombuffer(x, np.uint64), answer), f"shared-{r}"))
        del sent
        work.tidy()  # a round's shuffle files go before the next one writes its own
    return found


def _marked(spark: SparkSession, work: Work, packs: DataFrame, shared: list[DataFrame], config: Suffixes) -> DataFrame:
    """The marks of all samples that have any, one round after the other."""
    row_width = config.width + config.side + 2

    def send(buckets: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    ids, sizes, data = _open(row)
                    at = np.nonzero(_codes(row))[0]
                    if not len(at):
                        continue
                    owner = _owners(at, np.cumsum(sizes))
                    rows, docs = contexts(row, at, owner, config), ids[owner]
                    order, kind, first, low, _ = same_contexts(rows, docs)
                    # Of equal contexts one goes on, the smallest document's; that document's other ones share its answer.
                    goes = np.empty(len(first), np.int64)
                    least = np.nonzero(docs[order] == low[kind])[0][::-1]
                    goes[kind[least]] = order[least]
                    every = _every_shift(rows[goes], config)
                    known = np.ones(len(at), bool)
                    known[goes] = False
                    codes = np.empty(len(at), np.int64)
                    codes[order] = np.where(docs[order] > low[kind], every[kind], -1 - at[goes][kind])
                    goes = np.sort(goes)
                    part = (fingerprints(data, at[goes], config.mid) >> np.uint64(20)) % np.uint64(buckets)
                    yield _sent(row["chunk"], part.astype(np.int64), rows[goes], docs[goes], at[goes], at[known], codes[known])

        return run

    found = None
    for r, answers in enumerate(shared):
        total = answers.agg(F.sum(F.octet_length("places") / 4)).first()[0] or 0
        buckets = max(partitions(spark), -(-int(total) // config.run))
        sent = _answered(packs, answers, "inner").mapInArrow(send(buckets), _SENT)
        part = work.save(_sorted(sent, lambda x: np.frombuffer(x, np.uint8).reshape(-1, row_width), lambda rows, docs: marks(rows, docs, config)), f"marked-{r}")
        found = part if found is None else found.unionByName(part)
        del sent
        work.drop(f"shared-{r}")
        work.tidy()
    return found


def _spans(gone: np.ndarray) -> np.ndarray:
    return np.nonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))[0].reshape(-1, 2)


_CUT = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"


def _cut_rows(out: list[tuple]) -> pa.RecordBatch:
    ids, n, starts, ends, kept, *more = zip(*out, strict=True)
    cells = [int64(ids), int64(n), *(pa.array([np.asarray(x, np.int64) for x in c], pa.list_(pa.int64())) for c in (starts, ends)), pa.array(kept, pa.binary()), *map(int64, more)]
    return pa.RecordBatch.from_arrays(cells, ["doc_id", "n_bytes", "starts", "ends", "kept", "row", "at"][: len(cells)])


def substring_dedup(spark: SparkSession, docs: DataFrame, config: Suffixes = Suffixes()) -> DataFrame:
    """docs: doc_id (long), text. One row per document: doc_id, n_bytes, starts and ends (maximal removed
    spans, in bytes), kept (the remaining bytes).

    Removed is every byte covered by a string of `width` bytes that also starts in a document with a
    smaller doc_id, as the input has it; matches never cross documents and are decided on the bytes.
    Nulls: a null text is empty; a row with null doc_id is compared with nothing and kept whole. Repeated
    rows: rows of one doc_id are no smaller than each other, each has its own result. Ties: of equal
    strings the one in the smallest doc_id stays. Texts below `width` bytes stay. A very long text is
    sorted in parts of `chunk` bytes; only at the end is it one row. Empty input gives no rows. Other
    columns are ignored, whatever their names.
    """
    work = Work(spark, "suffix", "zstd")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    packs = work.bucket(pack(docs.where("doc_id is not null"), config), "packs", "chunk", max(partitions(spark), -(-size // config.bucket)))
    work.tidy()
    shared = _shared(spark, work, packs, int(size * len(COVERS[config.period]) / config.period), config)
    marked = _marked(spark, work, packs, shared, config)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes, data = _open(row)
                codes = _codes(row)
                at = np.nonzero(codes)[0]
                edge = np.zeros(len(data) + config.width + 1, np.int32)
                begins = np.zeros(len(data) + 1, bool)
                for shift in range(config.period):
                    begins[at[codes[at] >> shift & 1 != 0] - shift] = True
                at = np.nonzero(begins)[0]
                edge[at] += 1
                edge[at + config.width] -= 1
                gone = np.cumsum(edge)[: len(data)] > 0
                out = []
                if row["row"] >= 0:
                    spans, lead, own = _spans(gone) + row["at"], row["lead"], row["own"]
                    out.append((ids[0], own, spans[:, 0], spans[:, 1], data[lead : lead + own].tobytes(), row["row"], row["at"]))
                else:
                    for d, end, n in zip(ids.tolist(), np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
                        mine = gone[end - n : end]
                        spans = _spans(mine)
                        out.append((d, n, spans[:, 0], spans[:, 1], data[end - n : end][~mine].tobytes(), -1, 0))
                yield _cut_rows(out)

    def together(group: pa.Table) -> Iterator[pa.RecordBatch]:
        """The parts of one long text."""
        rows = sorted(group.to_pylist(), key=lambda x: x["at"])
        data = np.frombuffer(b"".join(x["kept"] for x in rows), np.uint8)
        edge = np.zeros(len(data) + 1, np.int32)
        for x in rows:
            np.add.at(edge, x["starts"], 1)
            np.add.at(edge, x["ends"], -1)
        gone = np.cumsum(edge)[:-1] > 0
        spans = _spans(gone)
        yield _cut_rows([(rows[0]["doc_id"], len(data), spans[:, 0], spans[:, 1], data[~gone].tobytes())])

    done = _answered(packs, marked, "left").mapInArrow(cut, f"{_CUT}, row long, at long")
    columns = ["doc_id", "n_bytes", "starts", "ends", "kept"]
    if not packs.where("row >= 0").isEmpty():
        done = work.save(done, "done")
        long = by_group(done.where("row >= 0"), ["row"], together, _CUT)
        done = done.where("row < 0").select(columns).unionByName(long)
    none = F.array().cast("array<long>")
    alone = docs.where("doc_id is null").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("starts"), none.alias("ends"), F.col("text").cast("binary").alias("kept"))
    return done.select(columns).unionByName(alone)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
q AS (SELECT r, doc_id, k, substr(h, 400 * k + 1, 498) AS t FROM (SELECT r, doc_id, h, unnest(range(0, (length(h) // 2 + 199) // 200)) AS k FROM d)),
b AS (SELECT r, 200 * k + o AS p, substr(t, 2 * o + 1, 2) AS x FROM (SELECT r, k, t, unnest(range(0, least(200, length(t) // 2))) AS o FROM q)),
w AS (SELECT r, doc_id, 200 * k + o AS p, md5_number(substr(t, 2 * o + 1, 100)) AS s FROM (SELECT r, doc_id, k, t, unnest(range(0, least(200, length(t) // 2 - 49))) AS o FROM q)),
m AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s HAVING max(doc_id) > min(doc_id)),
f AS (SELECT w.r, w.p FROM w JOIN m USING (s) WHERE w.doc_id > m.low),
c AS (SELECT b.r, b.p, b.x, coalesce(max(CASE WHEN f.p IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY b.r ORDER BY b.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM b LEFT JOIN f ON f.r = b.r AND f.p = b.p),
g AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY p) AS before FROM c),
a AS (SELECT r, sum(gone) AS n_removed, sum(CASE WHEN gone = 1 AND before = 0 THEN 1 ELSE 0 END) AS n_spans, coalesce(string_agg(x, '' ORDER BY p) FILTER (gone = 0), '') AS kept FROM g GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN a USING (r)"""
