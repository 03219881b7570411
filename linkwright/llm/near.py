"""Near-duplicate groups of any items that have a set of 64-bit hashes and a signature.

Band keys find rough groups; inside them pairs are screened on the signatures and confirmed on the
full sets. No step lists the pairs of a group: rough groups are dealt out in blocks, each block is
compared with itself and with one pivot block, and what those links leave apart meets across blocks
by the rarest elements of its sets, which pairs at the threshold must share. Every link between items
of one rough group is thereby either found or implied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, binaries, by_group, int64, mix, partitions, pieces, texts
from .components import connected

#: Items whose keys one map task combines before it passes them on, and keys that one reducing task sorts.
CHUNK, REDUCE = 1 << 15, 1 << 20
#: Items of a rough group that one block holds.
BLOCK = 160
#: Slots that elements' rarity is counted by and parts these are added up in; pairs of postings looked at at once.
SLOTS, SLOT_PARTS, MEET = 1 << 20, 64, 1 << 21
#: Bits of a set's mark beside its postings and where its pairs are confirmed, elements of the sets a task keeps there.
MARK, FINE_MARK, KEPT = 256, 2048, 1 << 21


def _least(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal keys the smallest id: (distinct keys, that id, edges of the others to it)."""
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1])
    least = np.minimum.reduceat(ids, starts)
    to = np.repeat(least, np.diff(np.concatenate([starts, [len(keys)]])))
    other = ids != to
    edges = np.unique(np.stack([ids[other], to[other]], 1), axis=0)
    return keys[starts], least, edges


def band_edges(spark: SparkSession, items: DataFrame, total: int, bands: int) -> DataFrame:
    """items: id, keys (binary of `bands` uint64); total: about how many. Edges (a, b) that join all
    items with an equal key.

    Map tasks combine equal keys first, so a key that a third of all items share reaches its reducer
    once from each chunk, and packed runs of 32-bit keys and ids travel rather than a row for each. Two
    keys of a reducer that agree in 32 bits only make one rough group of two; pairs are confirmed later.
    """
    buckets = max(partitions(spark), -(-total * bands // REDUCE))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids: list, keys: list) -> pa.RecordBatch:
            i = np.repeat(np.concatenate(ids), bands)
            k, least, edges = _least(np.concatenate(keys), i)
            part = (k % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part, least = part[order], least[order]
            short = (k[order] >> np.uint64(32)).astype(np.uint32)
            starts = np.concatenate([[0], np.nonzero(part[1:] != part[:-1])[0] + 1, [len(part)]])
            # The chunk's own edges ride along as one more run, to any reducer.
            ends, parts = np.append(starts, len(part)), np.append(part[starts[:-1]], int(k[0] % np.uint64(buckets)))
            own = np.zeros(len(ends), np.int64)
            own[-1] = edges.size
            return pa.RecordBatch.from_arrays([int64(parts), binaries(short, ends), binaries(least, ends), binaries(edges.reshape(-1), own)], ["part", "keys", "ids", "edges"])

        ids, keys, n = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            ids.append(b.column(0).to_numpy(zero_copy_only=False))
            keys.append(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint64))
            n += b.num_rows
            if n >= CHUNK:
                yield flush(ids, keys)
                ids, keys, n = [], [], 0
        if n:
            yield flush(ids, keys)

    def reduce(group: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, ids, edges = (np.frombuffer(b"".join(group.column(c).to_pylist()), kind) for c, kind in (("keys", np.uint32), ("ids", np.int64), ("edges", np.int64)))
        found = [edges.reshape(-1, 2)]
        if len(keys):
            found.append(_least(keys, ids)[2])
        both = np.concatenate(found)
        yield pa.RecordBatch.from_arrays([int64(both[:, 0]), int64(both[:, 1])], ["a", "b"])

    sent = items.select("id", "keys").mapInArrow(forward, "part long, keys binary, ids binary, edges binary")
    return by_group(sent, ["part"], reduce, "a long, b long")


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def links_within(ids, sizes, signatures, sets, apart, screen, threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Confirmed links that join what belongs together among these items.

    apart(i, j): of index arrays, which pairs are to be compared at all. Pairs go from the most to the
    least likely; one that the links so far already join needs no confirmation.
    """
    num, den = threshold
    n = len(ids)
    i, j = np.triu_indices(n, 1) if n > 2 else (np.array([0]), np.array([1]))
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    keep = (den * small >= num * large) & apart(i, j) & (ids[i] != ids[j])
    i, j = i[keep], j[keep]
    if not len(i):
        return []
    likely, order_by = screen(signatures, sizes, i, j)
    order = np.argsort(-order_by[likely], kind="stable")
    i, j = i[likely][order], j[likely][order]
    forest, out = _Forest(n), []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        ra, rb = forest.find(a), forest.find(b)
        if ra == rb:
            continue
        x, y = sets[a], sets[b]
        both = np.concatenate([x, y])
        both.sort()
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        if den * common >= num * (len(x) + len(y) - common):
            forest.up[rb] = ra
            out.append((int(ids[a]), int(ids[b])))
    return out


def _rows(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if found:
        x = np.array(found, np.int64)
        yield pa.RecordBatch.from_arrays([int64(x[:, 0]), int64(x[:, 1])], ["a", "b"])


def _once(ids: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Where each item is first, for rows may be repeated."""
    return np.sort(np.unique(np.stack([ids, *(x.astype(np.int64) for x in more)]), axis=1, return_index=True)[1])


def near_components(spark: SparkSession, work: Work, items: DataFrame, total: int, bands: int, fetch: Callable[[DataFrame], DataFrame], measure, screen, threshold: tuple[int, int], block: int = BLOCK, sets_of=None) -> DataFrame:
    """items: id, keys; total: about how many. Returns (id, comp) of the items that link with another;
    comp is the smallest id.

    fetch(placed) takes (id, grp, nb, blk) and returns (id, grp, nb, blk, text); it may name items anew.
    measure(texts) returns the sets of sorted distinct 64-bit hashes and the signatures; sets_of(texts) the sets only.
    screen(signatures, sizes, i, j) returns which pairs may link and how likely they are.
    """
    sets_of = sets_of or (lambda found: measure(found)[0])
    rough = work.save(connected(work, band_edges(spark, items, total, bands), "rough"), "rough")
    work.tidy()  # every step's shuffle files go before the next one writes its own
    counts = work.save(rough.groupBy("comp").agg(F.count("*").alias("cnt")).withColumn("nb", F.ceil(F.col("cnt") / block)), "counts")
    placed = rough.join(counts, "comp").select("id", F.col("comp").alias("grp"), "nb", F.pmod(F.xxhash64("id"), "nb").alias("blk"))
    held = work.save(fetch(work.save(placed, "placed")), "held")
    work.tidy()

    def prepare(batch: pa.RecordBatch) -> tuple:
        made = [measure(part) for _, part in pieces(texts(batch.column(batch.schema.get_field_index("text"))))]
        return [x for sets, _ in made for x in sets], np.concatenate([signatures for _, signatures in made])

    def items_of(group: pa.Table, parts: list[tuple], *more: str) -> tuple:
        """The group's rows without repeated ones: (rows' columns, (ids, sizes, signatures, sets))."""
        sets = [x for p in parts for x in p[0]]
        signatures = np.concatenate([p[1] for p in parts]) if len(parts) > 1 else parts[0][1]
        columns = {c: group.column(c).to_numpy(zero_copy_only=False) for c in ("id", *more)}
        if len(np.unique(columns["id"])) == len(sets):
            return columns, (columns["id"], np.array([len(x) for x in sets], np.int64), signatures, sets)
        # One id may have rows of different texts: those are items of their own.
        prints = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
        at = _once(columns["id"], prints, *(columns[c] for c in more[:1]))
        if len(at) < len(sets):
            sets, signatures = [sets[k] for k in at], signatures[at]
            columns = {c: x[at] for c, x in columns.items()}
        return columns, (columns["id"], np.array([len(x) for x in sets], np.int64), signatures, sets)

    def within(group: pa.Table, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        if group.num_rows < 2:
            return
        columns, items = items_of(group, parts, "blk")
        pivot = (columns["blk"] == 0) & (group.column("task")[0].as_py() != 0)
        if len(pivot) > 1:
            yield from _rows(links_within(*items, lambda i, j: ~(pivot[i] & pivot[j]), screen, threshold))

    tasks = F.when(F.col("blk") == 0, F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).otherwise(F.array("blk"))
    first = work.save(by_group(held.withColumn("task", F.explode(tasks)), ["grp", "task"], within, "a long, b long", prepare), "links")
    joined = work.save(connected(work, first, "first"), "joined")
    work.tidy()

    # What several blocks leave apart: all but the largest component of a rough group against the whole group.
    wide = work.save(held.where("nb > 1").select("id", "grp").distinct().join(joined, "id", "left").select("id", "grp", F.coalesce("comp", "id").alias("label")), "wide")
    parts = work.save(wide.groupBy("grp", "label").agg(F.count("*").alias("c")), "parts")
    left = work.save(parts.groupBy("grp").agg(F.max(F.struct("c", F.col("label"))).alias("top"), F.count("*").alias("n")).where("n > 1").select("grp", F.col("top.label").alias("top")), "left")
    if left.isEmpty():
        return joined
    marked = wide.join(left, "grp").select("id", "label", (F.col("label") != F.col("top")).alias("asks"))
    marked = work.save(held.where("nb > 1").select("id", "grp", "text").join(work.save(marked, "marked"), "id"), "apart")
    pairs = work.save(prefix_pairs(spark, marked, sets_of, threshold), "pairs")
    work.tidy()
    text_of = marked.select("id", "text").hint("merge")
    both = pairs.join(text_of.withColumnsRenamed({"id": "b", "text": "tb"}), "b").join(text_of.withColumnsRenamed({"id": "a", "text": "ta"}), "a")
    rest = both.select("a", "b", "label", "ta", "tb").mapInArrow(_confirmed(sets_of, threshold), "a long, b long")
    stars = joined.where("id <> comp").select(F.col("id").alias("a"), F.col("comp").alias("b"))
    across = work.save(rest, "links-across")
    work.tidy()
    return work.save(connected(work, across.unionByName(stars), "second"), "final")


def _rarity(items: DataFrame, sets_of: Callable[[list[bytes]], list[np.ndarray]]) -> tuple[np.ndarray, int]:
    """(of each slot of hashes how common its elements are, on a log scale; elements of all sets): counted
    over all texts, column 0 of items. Only the order of elements, and so no result, depends on it."""
    width = SLOTS // SLOT_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, part in pieces(texts(batch.column(0))):
                np.add.at(found, _slots(mix(np.concatenate(sets_of(part)))), 1)
        at = np.nonzero(found)[0]
        if len(at):
            ends = np.searchsorted(at, np.arange(SLOT_PARTS + 1) * width)
            yield pa.RecordBatch.from_arrays([int64(np.arange(SLOT_PARTS)), binaries((at % width).astype(np.int32), ends), binaries(found[at], ends)], ["part", "slots", "counts"])

    def add(group: pa.Table) -> Iterator[pa.RecordBatch]:
        slots, counts = (np.frombuffer(b"".join(group.column(c).to_pylist()), kind) for c, kind in (("slots", np.int32), ("counts", np.int64)))
        sums = np.zeros(width, np.int64)
        np.add.at(sums, slots, counts)
        levels = np.round(8 * np.log2(1 + sums)).clip(0, 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([group.column("part").combine_chunks().slice(0, 1), pa.array([levels.tobytes()], pa.binary()), int64([sums.sum()])], ["part", "levels", "n"])

    levels, total = np.zeros((SLOT_PARTS, width), np.uint8), 0
    for r in by_group(items.mapInArrow(count, "part long, slots binary, counts binary"), ["part"], add, "part long, levels binary, n long").collect():
        levels[r.part], total = np.frombuffer(bytes(r.levels), np.uint8), total + r.n
    return levels.reshape(-1), total


def _slots(mixed: np.ndarray) -> np.ndarray:
    return (mixed >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _marks(mixed: np.ndarray, owner: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Of n sets of mixed elements a row of bits each: whether an odd number of its elements is in that slot."""
    odd = np.bincount(owner * bits + (mixed & np.uint64(bits - 1)).astype(np.int64), minlength=n * bits) & 1
    return np.packbits(odd.astype(bool).reshape(n, bits), axis=1).view(np.uint64)


def _may_link(both, x: np.ndarray, y: np.ndarray, threshold: tuple[int, int]):
    """both: the sizes of two sets together. Every bit by which their marks differ stands for an element that is
    not common, so no pair at the threshold is lost."""
    num, den = threshold
    return (den + num) * (both - np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)) >= 2 * num * both


def prefix_pairs(spark: SparkSession, items: DataFrame, sets_of: Callable[[list[bytes]], list[np.ndarray]], threshold: tuple[int, int]) -> DataFrame:
    """items: id, grp, text, label, asks (label is not the group's largest). Distinct (a, b, label), label
    being b's, of one group and two labels: every pair that reaches the threshold is among them.

    With elements in one order, the rarest first, two sets of n and m elements and a similarity of at
    least t have a common element among the first n - ceil(t n) + 1 of the one and the like of the
    other. So each item is posted under those only, in packed runs: postings grow with the items,
    however large a group is. Of a pair's first common element both places bound what else it can share, and
    by how many bits their marks differ bounds it too.
    """
    num, den = threshold
    levels, total = _rarity(items.select("text"), sets_of)
    buckets = max(partitions(spark), -(-total * (den - num) // den // REDUCE))
    columns = {"keys": np.uint64, "ids": np.int64, "labels": np.int64, "asks": np.bool_, "sizes": np.int32, "places": np.int32, "marks": np.dtype(f"V{MARK // 8}")}

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "grp", "label", "asks")}
            for at, part in pieces(texts(batch.column("text"))):
                sets = sets_of(part)
                sizes = np.array([len(x) for x in sets], np.int64)
                h, owner = mix(np.concatenate(sets)), np.repeat(np.arange(len(sets)), sizes)
                marks = _marks(h, owner, len(sets), MARK).view(columns["marks"]).reshape(-1)
                h = levels[_slots(h)].astype(np.uint64) << np.uint64(56) | h >> np.uint64(8)
                h = h[np.lexsort((h, owner))]
                place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                here = place < (sizes - -(-num * sizes // den) + 1)[owner]
                owner, place = owner[here], place[here]
                keys = mix(h[here] ^ mix(rows["grp"][at + owner].astype(np.uint64)))
                to = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                to, owner = to[order], owner[order]
                ends = np.concatenate([[0], np.nonzero(to[1:] != to[:-1])[0] + 1, [len(to)]])
                if len(to):
                    cells = keys[order], *(rows[c][at + owner] for c in ("id", "label", "asks")), sizes[owner], place[order], marks[owner]
                    yield pa.RecordBatch.from_arrays([int64(to[ends[:-1]]), *(binaries(x.astype(kind), ends) for x, kind in zip(cells, columns.values(), strict=True))], ["part", *columns])

    def meet(group: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, ids, labels, asks, sizes, places, marks = (np.frombuffer(b"".join(group.column(c).to_pylist()), kind) for c, kind in columns.items())
        order = np.lexsort((sizes, keys))
        keys, ids, labels, asks, sizes, places, marks = (x[order] for x in (keys, ids, labels, asks, sizes.astype(np.int64), places.astype(np.int64), marks.view(np.uint64).reshape(-1, MARK // 64)))
        starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1])
        lengths = np.diff(np.append(starts, len(keys)))
        several = np.minimum.reduceat(labels, starts) != np.maximum.reduceat(labels, starts)
        asking = np.nonzero(asks & np.repeat(several, lengths))[0]
        # Of each one's list, which goes by size, those whose size allows the threshold.
        own, n = np.repeat(np.arange(len(starts)), lengths) << 32, sizes[asking]
        low = np.searchsorted(own | sizes, own[asking] | -(-num * n // den))
        many = np.searchsorted(own | sizes, own[asking] | den * n // num, "right") - low
        at, ends = 0, np.cumsum(many)
        while at < len(asking):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MEET, "right")))
            n = many[at:to]
            i = np.repeat(asking[at:to], n)
            j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[at:to], n)
            keep = (labels[i] != labels[j]) & ~(asks[j] & (ids[j] < ids[i]))
            i, j = i[keep], j[keep]
            # den * common >= num * (n + m - common) for what can still be common.
            common = np.minimum(sizes[i] - places[i], sizes[j] - places[j])
            keep = (den + num) * common >= num * (sizes[i] + sizes[j])
            i, j, at = i[keep], j[keep], to
            keep = _may_link(sizes[i] + sizes[j], marks[i], marks[j], threshold)
            i, j = i[keep], j[keep]
            if len(i):
                yield pa.RecordBatch.from_arrays([int64(ids[i]), int64(ids[j]), int64(labels[j])], ["a", "b", "label"])

    sent = items.mapInArrow(post, "part long, keys binary, ids binary, labels binary, asks binary, sizes binary, places binary, marks binary")
    return by_group(sent, ["part"], meet, "a long, b long, label long").distinct()


def _confirmed(sets_of: Callable[[list[bytes]], list[np.ndarray]], threshold: tuple[int, int]):
    num, den = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked, made, kept = set(), {}, 0

        def of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
            nonlocal kept
            if text not in made:
                if kept > KEPT:
                    made.clear()
                    kept = 0
                x = sets_of([text])[0]
                made[text] = x, _marks(mix(x), np.zeros(len(x), np.int64), 1, FINE_MARK)[0]
                kept += len(x) + len(text) // 8 + FINE_MARK // 64
            return made[text]

        for batch in batches:
            a, b, label = (batch.column(c).to_pylist() for c in ("a", "b", "label"))
            found = []
            others = texts(batch.column("tb"))
            for k, text in enumerate(texts(batch.column("ta"))):
                # What a has a link with already needs no more.
                if (a[k], label[k]) in linked:
                    continue
                (mine, x), (other, y) = of(text), of(others[k])
                if not _may_link(len(mine) + len(other), x, y, threshold):
                    continue
                both = np.concatenate([mine, other])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if den * common >= num * (len(mine) + len(other) - common):
                    linked.add((a[k], label[k]))
                    found.append((a[k], b[k]))
            yield from _rows(found)

    return run


def likely_jaccard(base: float, least: float, lost: float):
    """A screen on SetSketch registers: drops a pair when, given both sizes and how many registers are
    larger, smaller and equal, every Jaccard similarity of at least `least` is less likely by `lost`
    nats than the maximum likelihood estimate. The estimate orders the rest."""
    grid = np.concatenate([np.linspace(0.0, 0.98, 50), [0.99, 0.995, 1.0]])

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)

    def screen(signatures, sizes, i, j):
        more, less = np.empty(len(i), np.int32), np.empty(len(i), np.int32)
        for at in range(0, len(i), 1 << 14):
            x, y = signatures[i[at : at + (1 << 14)]], signatures[j[at : at + (1 << 14)]]
            more[at : at + (1 << 14)], less[at : at + (1 << 14)] = (x > y).sum(1), (x < y).sum(1)
        same = signatures.shape[1] - more - less
        u = sizes[i] / (sizes[i] + sizes[j])
        v = 1 - u
        top = np.full(len(i), -np.inf)
        top_link, best = top.copy(), np.zeros(len(i))
        limit = np.minimum(u / v, v / u)
        for s in grid:
            ok = s <= limit + 1e-9
            a, b = p(u - v * s), p(v - u * s)
            e = 1e-6
            fit = more * np.log(np.maximum(a, e)) + less * np.log(np.maximum(b, e)) + same * np.log(np.maximum(1 - a - b, e))
            fit = np.where(ok, fit, -np.inf)
            best = np.where(fit > top, s, best)
            top = np.maximum(top, fit)
            if s >= least - 0.011:
                top_link = np.maximum(top_link, fit)
        return top_link >= top - lost, best

    return screen


def likely_equal(least: float):
    """A screen on minima: drops a pair with fewer than `least` of its signature equal."""

    def screen(signatures, sizes, i, j):
        same = np.empty(len(i), np.float32)
        for at in range(0, len(i), 1 << 14):
            same[at : at + (1 << 14)] = (signatures[i[at : at + (1 << 14)]] == signatures[j[at : at + (1 << 14)]]).mean(1)
        return same >= least, same

    return screen


def hashed_bands(signatures: np.ndarray, rows: int) -> np.ndarray:
    """Keys of each band of `rows` columns: a row of uint64 per item, distinct between bands."""
    n, m = signatures.shape
    bands = m // rows
    key = np.zeros((n, bands), np.uint64)
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, : bands * rows].reshape(n, bands, rows)[:, :, r].astype(np.uint64) + np.uint64(r + 1))
    return mix(key + np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
