"""Every query of the linkage engine against the SQL that states the same result."""

import hashlib
import math
import random
import re

import duckdb
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from linkwright.operators import blocking, evaluate, features
from linkwright.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.001/{t}.parquet'")
    return c


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, duck, name):
    rows = QUERIES[name](spark, sf)
    columns = sorted(rows.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(cell(r[c]) for c in columns) for r in rows.collect()) == sorted(tuple(cell(r[i]) for i in at) for r in want.fetchall())


def test_reference_caps_keep_keys_of_more_than_forty(spark):
    posts = QUERIES["block_postings_reference"](spark, str(DATA / "sf0.01"))
    most = max(r["count"] for r in posts.groupBy("country", "fam", "key").count().collect())
    assert 40 < most <= 300


@pytest.mark.parametrize("name", ["key_family_a3", "block_candidates_numbers", "block_candidates_reference"])
def test_tokens_and_postings_are_not_broadcast(spark, sf, name):
    """All tables of sf0.001 would fit; what joins tokens, keys and postings does not depend on how small a file looks."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "BroadcastHashJoin" in x]
    assert "SortMergeJoin" in plan and not [x for x in joins if re.search(r"eid#|\bt#|key#", x)]


def test_neighbours_come_from_the_whole_table(spark, sf):
    rows = QUERIES["knn_embeddings_whole"](spark, sf).collect()
    assert all(r.vec_id % 20 == 0 and r.other != r.vec_id for r in rows) and any(r.other % 3 == 0 for r in rows)


def test_halves_are_rounded_as_in_sql(spark, duck):
    """Sums that end in a half of the last digit: as SQL rounds doubles, which Spark's own round does not."""
    r = random.Random(4)
    x = [(k + 0.5) / 10**6 for k in r.sample(range(30_000_000), 2000)]
    rows = spark.createDataFrame([(v,) for v in x], "x double").select("x", blocking.rounded(F.col("x"), 6), F.round("x", 6)).collect()
    want = dict(duck.execute("SELECT x, round(x, 6) FROM (SELECT unnest(?::DOUBLE[]) AS x)", [x]).fetchall())
    assert all(a == want[v] for v, a, _ in rows) and any(b != want[v] for v, _, b in rows)


def test_shared_weights_are_summed_as_in_sql(spark, duck, monkeypatch):
    """Two weights whose sum ends in a half of the seventh digit: as doubles add, which the exact sum is not."""
    r = random.Random(5)
    rows = []
    for k in range(2000):
        a = r.randrange(10**9, 12 * 10**9)
        rows += [(k, a / 10**9), (k, (r.randrange(10**6, 12 * 10**6) * 1000 + (500 - a) % 1000) / 10**9)]
    keys = spark.createDataFrame([(k, 1, "x", "A1", f"A1|{n}") for n, (k, _) in enumerate(rows)], "eid long, src int, country string, fam string, key string")
    posts = spark.createDataFrame([("x", "A1", f"A1|{n}", 10**6, w) for n, (_, w) in enumerate(rows)], "country string, fam string, key string, j long, w double")
    monkeypatch.setattr(blocking, "postings", lambda *_: posts)
    got = {x.i: x.w for x in blocking.family_hits(keys, keys).collect()}
    want = duck.execute("SELECT i, round(sum(w), 6) FROM (SELECT unnest(?::BIGINT[]) AS i, unnest(?::DOUBLE[]) AS w) GROUP BY i", [*map(list, zip(*rows, strict=True))]).fetchall()
    assert got == dict(want)


def test_ratios_of_candidates_are_rounded_as_in_sql(spark, duck):
    """Ratios of six-digit scores that end in a half of the seventh digit, within i and within j."""
    r = random.Random(6)
    rows = []
    for k in range(400):
        most = 2 * 10**6 * r.randrange(2, 12)
        part = most // (2 * 10**6) * (2 * r.randrange(10**6) + 1)
        rows += [(k, k, most / 10**6), (k, 10**6 + k, part / 10**6), (10**6 + k, k, part / 10**6)]
    pairs = spark.createDataFrame(rows, "i long, j long, s_all double").withColumn("n", F.col("s_all"))
    got = {(x.i, x.j): (x.cand_ratio, x.s1_ratio) for x in features.context_features(pairs, "n").collect()}
    want = duck.execute("SELECT i, j, round(s / max(s) OVER (PARTITION BY j), 6), round(s / max(s) OVER (PARTITION BY i), 6) FROM (SELECT unnest(?::BIGINT[]) AS i, unnest(?::BIGINT[]) AS j, unnest(?::DOUBLE[]) AS s)", [*map(list, zip(*rows, strict=True))]).fetchall()
    assert got == {(i, j): (a, b) for i, j, a, b in want}


def test_resamples_are_the_md5_draws(spark):
    """No row a record and round, and the draws of md5 itself."""
    rows = [(k**9, "ab"[k % 2], k / 7) for k in range(40)]
    made = evaluate.resampled(spark.createDataFrame(rows, "i long, country string, f double"), 120, 3)
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
    want = {}
    for i, country, f in rows:
        for k in range(1, 121):
            w = sum(hashlib.md5(f"3:{i}:{k}".encode()).hexdigest()[:8] >= x for x in evaluate.poisson_bounds())
            n, v = want.get((country, k), (0, 0.0))
            want[country, k] = n + w, v + w * f
    assert {(r.country, r.round): r.m for r in made.collect()} == pytest.approx({k: v / n for k, (n, v) in want.items() if n})


def test_pair_features_take_pairs_through_few_exchanges(spark, sf):
    """Pairs are not exploded by token, their records not normalized and blocked anew for each kind of feature."""
    plan = QUERIES["pair_features_all"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and len(re.findall(r"\bExchange hashpartitioning", plan)) <= 6


def test_rarities_of_pairs_across_countries(spark):
    """The other side's tokens have the idf of the asking record's country, or the largest of all where it has none."""
    r = random.Random(8)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(6))) for _ in range(60)]
    rows = [(k, 1 + k % 3, "xy"[k % 2], 0, "", texts[k], "", 0, texts[-k], "") for k in range(30)]
    records = spark.createDataFrame(rows, "eid long, src int, country string, script int, name_n string, name_core string, name_alias string, name_web int, addr_n string, addr_nums string")
    pairs = spark.createDataFrame([(a, b) for a in range(0, 30, 3) for b in range(30) if b % 3], "i long, j long")
    idf = {(x.kind, x.country, x.t): x.idf for x in features.token_idf(records).collect()}
    found = features.idf_features(features.pair_records(pairs, features.sides(pairs, records))).collect()
    assert len(found) == 200
    for x in found:
        for kind, a, b in (("name", x.name_core, x.name_core_b), ("addr", x.addr_n, x.addr_n_b)):
            top = max(v for (k, _, _), v in idf.items() if k == kind)
            a, b = set(a.split()), set(b.split())
            v = {t: idf.get((kind, x.country, t), top) for t in a | b}
            wa, wb, wc = (sum(v[t] for t in s) for s in (a, b, a & b))
            want = [max([0, *(v[t] for t in s)]) for s in (a - b, b - a)] + [wc / (m + 1e-6) for m in (min(wa, wb), max(wa, wb), wa + wb - wc)] + [wc]
            got = [x[f"{kind}_{n}"] for n in ("unm_a", "unm_b", "wov_min", "wov_max", "wjac", "wcommon")]
            assert got == pytest.approx(want, abs=2e-6)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
