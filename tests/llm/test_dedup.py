"""MinHash dedup, line dedup, substring dedup and decontamination against plain versions."""

import hashlib
import random

import brute
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linkwright.llm import decontaminate as dec
from linkwright.llm import lines, minhash, near, suffix
from linkwright.llm.common import Work, table
from linkwright.llm.components import connected

EXTRA = "id long, grp string, n long, part string, gone_ string, keys string, comp long"
LONG = " ".join(f"word{i}" for i in range(40))
ROWS = [
    (5, LONG), (2, LONG), (9, LONG.replace("word7 ", "other ")), (1, None), (3, ""), (4, " \n\t "), (6, "one two"), (7, "One  TWO"),
    (8, "é à ü"), (10, LONG[:70]), (11, LONG + "\n" + LONG), (12, "tail " + LONG), (13, "x" * 5000), (14, "y " * 3000),
]


def frame(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    return d.selectExpr("*", "1L as id", "'g' as grp", "2L as n", "'p' as part", "'z' as gone_", "'k' as keys", "3L as comp")


def rows_of(spark, sf):
    return [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]


@pytest.fixture(params=["edge", "table"])
def case(request, spark, sf):
    rows = ROWS if request.param == "edge" else rows_of(spark, sf)
    return rows, frame(spark, rows)


def test_minhash(case, spark):
    rows, d = case
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.minhash_dedup(spark, d).collect()}
    assert got == brute.op1(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in minhash.minhash_dedup(spark, d).collect())


def test_lines(case, spark):
    rows, d = case
    out = lines.line_dedup(spark, d)
    assert out.columns == [*d.columns, "n_lines", "n_dropped"]
    assert {r.doc_id: r.text for r in out.collect()} == brute.op9(rows)


def test_substrings(case, spark):
    rows, d = case
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.starts), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix.substring_dedup(spark, d).collect()}
    assert got == brute.op5(rows)


@pytest.mark.parametrize("chunk", [200_000, 7])
def test_decontamination(case, spark, sf, chunk):
    rows, d = case
    items = [tuple(r) for r in table(spark, sf, "benchmark").collect()] + [(900, LONG), (901, "one two"), (902, None), (903, "..."), (904, LONG), (None, "word1")]
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as block", "'x' as terms")
    if chunk == 7 and len(rows) > 50:
        rows = rows[:8] + ROWS
        d = frame(spark, rows)
        items = items[:2] + items[-6:]
        b = spark.createDataFrame(items, "item_id long, text string")
    found = dec.decontaminate(spark, d, b, dec.Match(chunk=chunk, block=2000)).collect()
    want = brute.op7(rows, [x for x in items if x[0] is not None])
    got = {r.doc_id: (r.n_words, sum(e - s for s, e in zip(r.starts, r.ends)), len(r["items"]), hashlib.sha256(",".join(map(str, r["items"])).encode()).hexdigest(), bool(r["items"])) for r in found}
    assert got == want


def test_proximity(spark):
    words = [f"a{i}" for i in range(10)]
    shuffled = words[::-1]
    d = spark.createDataFrame([(1, " ".join(shuffled)), (2, " ".join(words[:5] + ["zz"] * 3 + words[5:])), (3, " ".join(words[:5] + ["zz"] * 9 + words[5:]))], "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: (list(r["items"]), list(r.near_items)) for r in dec.decontaminate(spark, d, b, dec.Match(slop=4)).collect()}
    assert got == {1: ([], [1]), 2: ([], [1]), 3: ([], [])}


@settings(max_examples=80, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from("abcdefg"), max_size=40), st.lists(st.lists(st.sampled_from("abcdefg"), min_size=1, max_size=4), min_size=1, max_size=4), st.integers(0, 3))
def test_proximity_against_all_spans(words, windows, slop):
    import numpy as np

    width, vocabulary = 4, sorted(set(words))
    windows = [w for w in windows if set(w) <= set(vocabulary)]
    if not windows:
        return
    lookup = np.sort(np.array([(vocabulary.index(x) << 32) + k for k, x in enumerate(words)], np.int64))
    ends = np.cumsum([words.count(x) for x in vocabulary])
    lengths = np.array([len(w) for w in windows])
    rank = np.array([[vocabulary.index(x) for x in w] + [0] * (width - len(w)) for w in windows])
    high = ends[rank]
    low = np.where(rank > 0, ends[rank - 1], 0)
    want = {i for i, w in enumerate(windows) for k in range(len(words)) if set(w) <= set(words[k : k + len(w) + slop])}
    assert set(dec._nearby(lookup, low, high, rank, lengths, slop)[:, 0].tolist()) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.minhash_dedup(spark, none).collect() == []
    assert lines.line_dedup(spark, none).collect() == []
    assert suffix.substring_dedup(spark, none).collect() == []
    items = spark.createDataFrame([], "item_id long, text string")
    assert dec.decontaminate(spark, none, items).collect() == []
    assert [r.n_words for r in dec.decontaminate(spark, frame(spark, ROWS[:1]), items).collect()] == [40]


def test_null_ids_and_repeated_rows(spark):
    d = frame(spark, [(None, LONG), (None, LONG), (1, LONG), (1, LONG), (2, LONG)])
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in minhash.minhash_dedup(spark, d).collect())
    assert got == [(0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert sorted((r.doc_id or 0, r.text) for r in lines.line_dedup(spark, d).collect()) == [(0, LONG), (0, LONG), (1, LONG), (1, LONG), (2, "")]
    assert sorted((r.doc_id or 0, len(r.kept)) for r in suffix.substring_dedup(spark, d).collect()) == [(0, len(LONG)), (0, len(LONG)), (1, len(LONG)), (1, len(LONG)), (2, 0)]


def test_one_document_of_several_texts_joins_their_classes(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (9, b), (20, c), (21, c.replace("c3 ", "z ")), (5, c.replace("c29", "y")), (30, None), (9, "")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.minhash_dedup(spark, frame(spark, rows)).collect())
    assert got == [(1, 26, 1, True), (5, 26, 1, False), (5, 26, 1, False), (5, 26, 1, False), (9, 0, 9, True), (9, 26, 1, False), (20, 26, 1, False), (21, 26, 21, True), (30, 0, 30, True)]


def test_substrings_of_repeated_ids_in_two_chunks(spark):
    """The first chunk holds documents 1 and, often, 9, the second only a row of 9."""
    text = "word0 word1 word2 word3 word4 word5 word6 word7 wo"
    d = spark.createDataFrame([(1, text)] + [(9, text)] * 301, "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id, bytes(r.kept).decode()) for r in suffix.substring_dedup(spark, d, suffix.Suffixes(chunk=50 * 301, rounds=1)).collect())
    assert got == [(1, text)] + [(9, "")] * 301


def near_copies(n, seed, words=60):
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.choice((0, 1, 1, 2, 3))):
            w[r.randrange(words)] = f"e{r.randrange(10**6)}"
        out.append((i, " ".join(w)))
    return out


def test_line_bands_meet_pairs_at_the_threshold():
    """5,000 pairs of lines at Jaccard 0.803: each shares a band and passes the screen."""
    r, config, found = random.Random(5), lines.Lines(), []
    for _ in range(5000):
        head = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=268))
        found += [(head + "".join(r.choices(letters, k=32))).encode() for letters in ("0123456789", "!$%&/()=?#")]
    assert 0.8 <= 261 / 325 < 0.81 and len(set(found)) == 10_000
    least = lines.minima(found, config.minima)
    keys = near.hashed_bands(least, config.rows)
    assert (keys[::2] == keys[1::2]).any(axis=1).all()
    pairs = range(0, 10_000, 2), range(1, 10_000, 2)
    assert near.likely_equal(config.least)(least, None, *map(list, pairs))[0].all()


def test_lines_of_other_scripts(spark):
    """One changed character of a long line in two- and three-byte scripts; shingles are of characters."""
    cyrillic, chinese = "строка текста которая повторяется почти без изменений " * 3, "这是一个几乎没有变化的重复的行" * 6
    rows = [(1, cyrillic), (2, cyrillic.replace("почти", "почта", 1)), (3, chinese), (4, chinese[:40] + "小" + chinese[41:]), (5, chinese[:60]), (6, "короткая"), (7, "Короткая"), (8, "короткая")]
    assert {r.doc_id: r.text for r in lines.line_dedup(spark, frame(spark, rows)).collect()} == brute.op9(rows)


def test_large_group_is_split_in_blocks(spark):
    """A group of several blocks, with pairs on both sides of the threshold: components stay exact."""
    rows = near_copies(90, 1) + [(1000 + i, t) for i, t in near_copies(40, 2)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.minhash_dedup(spark, frame(spark, rows), minhash.Sketch(block=12)).collect()}
    assert got == brute.op1(rows)
    rows = [(i, t[:300]) for i, t in near_copies(60, 3)]
    got = {r.doc_id: r.text for r in lines.line_dedup(spark, frame(spark, rows), lines.Lines(block=9)).collect()}
    assert got == brute.op9(rows)


def test_a_group_left_apart_is_measured_a_few_times_an_item(spark):
    """One rough group whose texts do not link but for one pair: work grows with the items, not with blocks
    times blocks."""
    r, n, seen = random.Random(8), 400, spark.sparkContext.accumulator(0)
    words = [b"w%d" % k for k in range(6000)]
    found = [b" ".join(r.sample(words, 12)) for _ in range(n - 2)] + [b"x y z u v", b"x y z u v s"]

    def sets_of(part):
        seen.add(len(part))
        return [minhash.shingle_sets([x], 1, minhash._Words())[0] for x in part]

    def measure(part):
        return sets_of(part), lines.minima([x.ljust(8) for x in part], 96)

    texts = spark.createDataFrame(list(enumerate(map(bytearray, found))), "id long, text binary")
    keys = spark.createDataFrame([(k, bytearray((7).to_bytes(8, "little"))) for k in range(n)], "id long, keys binary")
    got = near.near_components(spark, Work(spark, "t"), keys, n, 1, lambda placed: placed.join(texts, "id").select("id", "grp", "nb", "blk", "text"), measure, near.likely_equal(0.0), (80, 100), 4, sets_of)
    assert {(x.id, x.comp) for x in got.collect()} == {(n - 2, n - 2), (n - 1, n - 2)}
    assert seen.value < 10 * n


def test_pairs_far_from_the_threshold_are_not_read_again(spark):
    """Sets with a rare element in common, but half of the rest: their texts are not fetched; near ones all are."""
    r, found = random.Random(9), []
    for k in range(30):
        group = [[f"g{k}", *(f"{k}.{x}" for x in r.sample(range(200), 100))] for _ in range(9)]
        found += [*group, group[0][:-1]]
    rows = [(n, 1, bytearray(" ".join(x).encode()), n, True) for n, x in enumerate(found)]

    def sets_of(part):
        return [minhash.shingle_sets([x], 1, minhash._Words())[0] for x in part]

    items = spark.createDataFrame(rows, "id long, grp long, text binary, label long, asks boolean")
    got = {tuple(sorted((x.a, x.b))) for x in near.prefix_pairs(spark, items, sets_of, (80, 100)).collect()}
    assert {(k, k + 9) for k in range(0, 300, 10)} <= got and len(got) < 60


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    work = Work(spark, "test")
    got = {x.id: x.comp for x in connected(work, spark.createDataFrame(edges, "a long, b long"), "c").collect()}
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    index = {x: i for i, x in enumerate(nodes)}
    comp = brute.components(len(nodes), [(index[a], index[b]) for a, b in edges if a != b])
    assert got == {x: nodes[c] for x, c in zip(nodes, comp)}


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab é\n", max_size=60), max_size=6))
def test_fingerprints_tell_strings_apart(found):
    import numpy as np

    data = np.frombuffer("".join(found).encode().ljust(80, b"."), np.uint8)
    at = np.arange(len(data) - 30 + 1)
    seen = {}
    for k, i in zip(suffix.fingerprints(data, at, 30, step=16).tolist(), at.tolist()):
        s = bytes(data[i : i + 30])
        assert seen.setdefault(s, k) == k
    assert len(set(seen.values())) == len(seen)


def plain_marks(found, width, period):
    """{(document, place): shifts} of the windows over each place that begin in a smaller document too."""
    first = {}
    for d, t in found:
        for i in range(len(t) - width + 1):
            first[t[i : i + width]] = min(d, first.get(t[i : i + width], d))
    out = {}
    for n, (d, t) in enumerate(found):
        for i in range(len(t) - width + 1):
            if first[t[i : i + width]] < d:
                for shift in range(period):
                    out.setdefault((n, i + shift), set()).add(shift)
    return out


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.text(alphabet="ab", max_size=40)), min_size=1, max_size=5), st.sampled_from([(12, 7), (8, 7), (20, 13), (50, 21)]))
def test_marks_of_a_bucket(found, sizes):
    """Ranks and classes against all windows; ties reach far beyond the cover's period."""
    import numpy as np

    config = suffix.Suffixes(width=sizes[0], period=sizes[1])
    found = [(d, (t * 3).encode()) for d, t in found]
    row = {"doc_ids": np.array([d for d, _ in found], np.int64).tobytes(), "sizes": np.array([len(t) for _, t in found], np.int64).tobytes(), "data": b"".join(t for _, t in found)}
    ends = np.cumsum([len(t) for _, t in found])
    at = np.arange(ends[-1])
    owner = suffix._owners(at, ends)
    ok = at + config.mid <= ends[owner]
    at, owner = at[ok], owner[ok]
    want = plain_marks(found, *sizes)
    if len(at):
        got = suffix.marks(suffix.contexts(row, at, owner, config), np.array([d for d, _ in found])[owner], config)
        for n, a, m in zip(owner.tolist(), at.tolist(), got.tolist()):
            place = a - int(ends[n] - len(found[n][1]))
            assert {s for s in range(sizes[1]) if m >> s & 1} == {s for s in want.get((n, place), ()) if place - s >= 0}


@pytest.mark.parametrize("config", [suffix.Suffixes(chunk=400, rounds=2, run=500), suffix.Suffixes(width=30, period=13, chunk=260, rounds=1), suffix.Suffixes(width=9, period=7, chunk=70)])
def test_long_texts_in_parts(spark, config):
    """Texts of many chunks: matches across their seams, whole copies, and runs of one character."""
    r = random.Random(8)
    base = "".join(r.choices("abcdefg é", k=3000))
    rows = [(5, base), (2, base[700:1500]), (7, "z" * 200 + base[390:420] + "y" * 2500), (8, base[:1200] + "!" + base[1200:]), (9, "z" * 900), (11, base), (11, base[5:]), (12, base[100:140]), (20, "short")]
    want = {}
    for d, t in rows:  # rows of one document are no smaller than each other
        smaller = [x.encode() for e, x in rows if e < d]
        t = t.encode()
        gone = bytearray(len(t))
        for i in range(len(t) - config.width + 1):
            if any(t[i : i + config.width] in x for x in smaller):
                gone[i : i + config.width] = b"\1" * config.width
        want.setdefault(d, []).append(bytes(x for x, g in zip(t, gone) if not g))
    got = {}
    for x in suffix.substring_dedup(spark, frame(spark, rows), config).collect():
        got.setdefault(x.doc_id, []).append(bytes(x.kept))
        assert x.n_bytes - sum(b - a for a, b in zip(x.starts, x.ends)) == len(x.kept)
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}


def test_covers():
    for v, d in suffix.COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_sketches_estimate_and_merge():
    import numpy as np

    from linkwright.llm.near import likely_jaccard

    s = minhash.Sketch()
    r = np.random.default_rng(1)
    pool = np.unique(r.integers(0, 2**63, 3000).astype(np.uint64))
    a, b = pool[:2000], pool[500:2500]
    ra, rb, both = minhash.sketches([a, b, np.union1d(a, b)], s)
    assert (np.maximum(ra, rb) == both).all()
    _, best = likely_jaccard(s.base, 0.75, s.lost)(np.stack([ra, rb]), np.array([len(a), len(b)]), np.array([0]), np.array([1]))
    assert abs(best[0] - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.15


def test_only_what_is_still_read_stays_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Work, "_root", staticmethod(lambda spark: f"file://{tmp_path}"))
    d = frame(spark, ROWS)
    kept = lines.line_dedup(spark, d), minhash.minhash_dedup(spark, d)
    assert sorted(p.name for p in tmp_path.glob("lines-*/*")) == ["gone"]
    assert sorted(p.name for p in tmp_path.glob("minhash-*/*")) == ["named", "profile"]
    assert [x.count() for x in kept] == [len(ROWS)] * 2
