"""Text functions, similarity and decisions against known answers and plain enumeration."""

import itertools
import random
import time

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwright.functions import similarity as sim
from linkwright.functions import text
from linkwright.operators import decide, evaluate, learn, splits
from linkwright.operators.normalize import address_views, name_views, normalize, normalize_frame

# ---------------------------------------------------------------- normalization


def one(spark, name="", addr="", **kw):
    d = spark.createDataFrame([(1, 1, "us", name, addr)], "eid long, src int, country string, name_raw string, addr_raw string")
    return normalize(d, **kw).first()


@pytest.mark.parametrize(
    "name, core",
    [("ABC Trading Pvt. Ltd.", "abc trading"), ("abc trading private limited", "abc trading"), ("Café & Crème SARL", "cafe creme"), ("The Ltd", "the limited"), ("M/s O'Neil (id: 7) l.l.p", "oneil"), ("www.big-shop.com", "big shop"), ("", "")],
)
def test_name_core(spark, name, core):
    assert one(spark, name).name_core == core


def test_record_details(spark):
    r = one(spark, "Foo Bar dba Zed Inc", "12th St., 007 Rd 16west <null> N/A", rules="n1")
    assert (r.name_alias, r.name_web, r.addr_n, r.addr_nums) == ("zed", 0, "12 street 7 road 16 west".replace(" 7 ", " 007 "), "12 16 7")
    assert one(spark, "pvtltd x").name_n == "private limited x"
    assert [one(spark, n).script for n in ("abc", "café", "магазин")] == [0, 1, 2]
    assert one(spark, "Магазин", any_script=True).name_n == "magazin"
    assert one(spark, None, None).name_n == ""
    assert one(spark, "x", "France 000").addr_nums == "0"


def test_spelling_of_scripts():
    names = {
        "Магазин Щука": "magazin shchuka", "Юрий Чайковский": "yuriy chaykovskiy", "Київ": "kiyiv", "Εταιρεία": "etaireia", "Θεσσαλονίκη": "thessaloniki", "भारत": "bharat", "नमस्ते": "namaste",
        "मुंबई": "munbai", "हिन्दी १२३": "hindi 123", "ગુજરાત": "gujarat", "café Ñandú": "cafe Nandu", "ABC 12": "ABC 12", "": "",
    }
    assert {k: text.spell(k) for k in names} == names


def test_views(spark):
    d = spark.createDataFrame([("ABC Trading Pvt Ltd", "12, M.G. Rd, Near SBI ATM, Pune 411001", "in"), ("Café & Crème S A R L", "", "in")], "name_raw string, addr_raw string, country string")
    a, b = name_views(d).collect()
    assert (a.name_core, a.name_legal, a.name_acronym, a.name_compact) == ("abc trading", "limited private", "at", "abctrading")
    assert (b.name_core, b.name_sorted, b.name_legal) == ("cafe and creme", "cafe creme", "sarl")
    a = address_views(d).first()
    assert "road" in a.addr_norm and (a.addr_postal, a.addr_first_num, a.addr_landmark) == ("411001", "12", 1)
    assert len(normalize_frame(d).columns) == 3 + 13 + 1


def test_skeleton(spark):
    words = ["private", "praivet", "emtr", "shree", "bhatt", "xerox", "phone", "", "a", "chh", "mumbai", "pizzza"]
    d = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in d.select(text.skeleton(F.col("w"))).collect()] == [text.skeleton_of(w) for w in words]
    assert text.skeleton_of("private") == text.skeleton_of("praivet")


def test_ids(spark):
    d = spark.createDataFrame([("S1-7",), ("S3-999999999999",), ("S4-1",), ("S1-",), ("S1-1234567890123",), ("x",)], "c string")
    assert [r[0] for r in d.select(text.encode_id(F.col("c"))).collect()] == [10**12 + 7, 3 * 10**12 + 999999999999, None, None, None, None]
    ids = spark.createDataFrame([(10**12 + 7,), (3 * 10**12 + 999999999999,)], "e long")
    assert [r[0] for r in ids.select(text.decode_id(F.col("e"))).collect()] == ["S1-7", "S3-999999999999"]


# ---------------------------------------------------------------- similarity


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            row[j + 1], last = max(row[j], row[j + 1]) if x != y else last + 1, row[j + 1]
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc ", max_size=20), st.text(alphabet="abc ", max_size=20))
def test_ratio_and_winkler(a, b):
    n = len(a) + len(b)
    assert sim.ratio(a, b) == pytest.approx(200 * plain_lcs(a, b) / n if n else 100)
    assert sim.partial(a, b) == pytest.approx(sim.partial(b, a))
    if a and b:
        assert sim.jaro_winkler(a, b) == pytest.approx(duckdb.sql(f"SELECT jaro_winkler_similarity('{a}', '{b}')").fetchall()[0][0])


def test_token_scores():
    assert sim.token_sort("b a", "a b") == 100 and sim.token_set("a b", "b a c d") == 100
    assert sim.token_set("", "a") == 0 and sim.partial_token_set("a x", "x q") == 100
    assert sim.token_set("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert sim.partial("bear", "a bear there") == 100 and sim.jaro_winkler("", "") == 1
    assert sim.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)


@pytest.mark.parametrize("name", ["lcs", "ratio", "token_sort", "token_set", "partial", "partial_token_set", "jaro_winkler"])
def test_scores_of_all_pairs_are_those_of_each(name):
    draw = random.Random(3)

    def word(letters, n):
        return "".join(draw.choice(letters) for _ in range(n))

    a, b = [], []
    for _ in range(400):
        letters = draw.choice(["ab", "abcdefghij", "aé日本😀x", "abc0123456789"])
        a.append(" ".join(word(letters, draw.choice([0, 1, 2, 3, 5, 9, 30, 70])) for _ in range(draw.choice([0, 1, 2, 4, 6]))).strip())
        other = " ".join(word(letters, draw.choice([1, 3, 7])) for _ in range(draw.choice([0, 1, 5])))
        b.append(draw.choice([a[-1], other, "".join(c for c in a[-1] if draw.random() < 0.9), " ".join(sorted(a[-1].split())) + " " + other]))
    assert getattr(sim, f"{name}_all")(a, b).tolist() == [getattr(sim, name)(*p) for p in zip(a, b)]


def test_partial_of_all_pairs_takes_little_time():
    # As names are; one pair at a time it took a millisecond or more each.
    draw = random.Random(4)
    a, b = ([" ".join("".join(draw.choice("etaoinshrdlu") for _ in range(6)) for _ in range(6)) for _ in range(4000)] for _ in "ab")
    began = time.process_time()
    each = [sim.partial(*p) for p in zip(a[:100], b)]
    one = (time.process_time() - began) / 100
    began = time.process_time()
    assert sim.partial_all(a, b)[:100].tolist() == each
    assert (time.process_time() - began) / len(a) < one / 4


# ---------------------------------------------------------------- decisions


@pytest.mark.parametrize("missed", [[], [0.3], [0.3, 0.1]])
def test_expected_f_is_the_mean_over_all_worlds(spark, missed):
    cases = [[0.9, 0.6, 0.3, 0.1], [0.5], [0.2, 0.2, 0.2], [0.99, 0.95, 0.9, 0.4, 0.05], [0.7] * 6, [1.0, 0.0]]
    d = spark.createDataFrame([(p, missed) for p in cases], "p array<double>, missed array<double>")
    for p, curve in d.select("p", decide.expected_f(F.col("p"), 4, F.col("missed"))).collect():
        assert len(curve) == min(len(p), 4) + 1
        for k, got in enumerate(curve):
            want = 0.0
            q = [*p, *missed]
            for world in itertools.product((0, 1), repeat=len(q)):
                weight = np.prod([x if w else 1 - x for x, w in zip(q, world)])
                want += weight * evaluate.f_sets(set(range(k)), {i for i, w in enumerate(world) if w})
            assert got == pytest.approx(want, abs=1e-9)


def test_expected_f_choices(spark):
    s = spark.createDataFrame([(1, 11, 0.3), (1, 12, 0.2), (2, 21, 0.95), (2, 22, 0.9), (2, 23, 0.05), (3, 31, 1e-4)], "i long, j long, p double")
    ids = spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "i long")
    got = {r.i: list(r.ids) for r in decide.decide_expected_f(ids, s).collect()}
    assert got == {1: [], 2: [21, 22], 3: [], 4: []}


def test_one_owner(spark):
    s = spark.createDataFrame([(1, 9, 0.9), (2, 9, 0.6), (3, 8, 0.4), (4, 8, 0.4)], "i long, j long, p double")
    assert {r.i: r.p for r in decide.one_owner(s, "hard").collect()} == {1: 0.9, 2: 0.0, 3: 0.4, 4: 0.4}
    soft = {r.i: r.p for r in decide.one_owner(s, "soft").collect()}
    assert soft[1] + soft[2] == pytest.approx(1) and soft[3] == 0.4
    assert decide.one_owner(s, "none") is s


def test_ensemble_needs_every_pair(spark):
    a = spark.createDataFrame([(1, 9, 0.9), (2, 9, 0.6)], "i long, j long, p double")
    assert {r.i: r.p for r in decide.ensemble([a, a.withColumn("p", F.col("p") / 3)]).collect()} == {1: pytest.approx(0.6), 2: pytest.approx(0.4)}
    with pytest.raises(Exception, match="missing"):
        decide.ensemble([a, a.limit(1)]).collect()


def test_f_sets():
    assert evaluate.f_sets({1, 2, 3}, {1, 2}) == pytest.approx(0.7142857)
    assert [evaluate.f_sets(a, b) for a, b in ((set(), set()), ({1}, set()), (set(), {1}), ({2}, {1}))] == [1, 0, 0, 0]


def test_macro_counts_every_record(spark):
    ids = spark.createDataFrame([(1, "us"), (2, "us")], "i long, country string")
    none = spark.createDataFrame([], "i long, j long")
    truth = spark.createDataFrame([(2, 9)], "i long, j long")
    assert evaluate.summary(evaluate.per_record(ids, none, truth)).where("country = 'ALL'").first().macro_f05 == 0.5


def test_shapley_is_the_mean_over_all_orders(spark):
    pred, truth = {1: {11, 12, 13}, 2: {21}, 3: set(), 4: {41}}, {1: {11, 14, 15}, 3: {31}, 4: {41}}
    p = {(1, 14): 0.6, (1, 15): 0.1, (3, 31): 0.2}
    scores = [(i, j, 0.9) for i, js in pred.items() for j in js] + [(i, j, x) for (i, j), x in p.items()]
    cat = {(1, 12): "multi_fp", (1, 13): "multi_fp", (1, 14): "rejected", (1, 15): "missed_extra", (2, 21): "singleton_fp", (3, 31): "scored_low"}
    frames = spark.createDataFrame(scores, "i long, j long, p double"), spark.createDataFrame([(i, j) for i, js in truth.items() for j in js], "i long, j long")
    assert {(r.i, r.j): r.cat for r in evaluate.label_errors(*frames, 0.75).collect()} == cat
    ids = spark.createDataFrame([(i, "us") for i in pred], "i long, country string")
    want = {}
    for i in pred:
        kinds = sorted({c for (k, _), c in cat.items() if k == i})
        orders = list(itertools.permutations(kinds))
        for order in orders:
            now = set(pred[i])
            for c in order:
                then = now ^ {j for (k, j), x in cat.items() if k == i and x == c}
                want[i, c] = want.get((i, c), 0) + (evaluate.f_sets(then, truth.get(i, set())) - evaluate.f_sets(now, truth.get(i, set()))) / len(orders)
                now = then
    got = {(r.i, r.cat): r.loss for r in evaluate.shapley_losses(ids, *frames, 0.75).collect()}
    assert got == pytest.approx(want) and len(got) == 5


def test_isotonic_pools(spark):
    import pandas as pd

    r = random.Random(1)
    rows = pd.DataFrame({"x": range(40), "n": [5.0] * 40, "s": [float(min(5, max(0, k // 8 + r.randrange(-1, 2)))) for k in range(40)]})
    steps = next(decide.isotonic(iter([rows])))
    assert steps["value"].is_monotonic_increasing and steps["upto"].iloc[-1] == 39
    assert (steps["value"] * np.diff(steps["upto"], prepend=-1) * 5).sum() == pytest.approx(rows["s"].sum())


def test_models_round_trip(spark, tmp_path):
    d = spark.range(400).select(F.col("id").alias("i"), F.col("id").alias("j"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b")).withColumn("y", (F.col("a") > 3).cast("int"))
    model = learn.fit(d, ["a", "b"], rounds=3)
    model.save(f"file://{tmp_path}/m")
    again = learn.load(f"file://{tmp_path}/m", ["a", "b"])
    rows = learn.score(again, d).collect()
    assert all((r.p > 0.5) == (r.y == 1) for r in rows)
    assert learn.importance(again, ["a", "b"])["feature"].iloc[0] == "a"
    assert learn.score_average([model, again], d).count() == 400
    with pytest.raises(ValueError, match="other features"):
        learn.load(f"file://{tmp_path}/m", ["b", "a"])


def test_samples_are_disjoint(spark, sf):
    from linkwright.plans.pairs import ids, truth

    strata = splits.buckets(ids(spark, sf), truth(spark, sf))
    dev = ids(spark, sf).where(splits.in_sample(5, 7))
    box = splits.lockbox(strata, dev, 0.4, 1)
    assert box.count() > 0 and box.join(dev, "i", "left_semi").count() == 0
    assert {r[0] for r in splits.folds(strata, 3, 1).select("fold").distinct().collect()} == {0, 1, 2}
