"""Queries of evaluation, splits, validation, profiles, learning and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import decode_id, skeletons
from ..operators import decide as dec
from ..operators import evaluate as ev
from ..operators import learn
from ..operators import profile as prof
from ..operators import splits as sp
from ..operators import validate as val
from ..operators.features import fuzzy_features, legal_skeleton, pair_records, token_idf
from ..operators.neighbours import top_k
from . import sql
from .blocking import CAPPED, documents
from .pairs import OWNED, SCORES, _cand, ids, scores, truth
from .records import DOCUMENTS_SQL, load

TAUS = [0.3, 0.5, 0.7, 0.75, 0.9]


def _chosen(s, f, tau=0.75):
    return dec.one_owner(scores(s, f), "hard").where(F.col("p") >= tau)


def _records(s, f):
    return ev.per_record(ids(s, f), _chosen(s, f).select("i", "j"), truth(s, f))


_F = "CASE WHEN n_pred = 0 AND n_true = 0 THEN 1.0 WHEN n_pred = 0 OR n_true = 0 THEN 0.0 ELSE 1.25 * tp / (0.25 * n_true + n_pred) END"
CHOSEN = SCORES + OWNED + ", chosen AS (SELECT i, j, src FROM owned WHERE p >= 0.75)"
PER = f""",
cnt AS (SELECT coalesce(t.i, c.i) AS i, count(t.j) AS n_true, count(c.j) AS n_pred, count(*) FILTER (t.j IS NOT NULL AND c.j IS NOT NULL) AS tp
  FROM (SELECT i, j FROM truth) t FULL JOIN (SELECT i, j FROM chosen) c ON t.i = c.i AND t.j = c.j GROUP BY ALL),
per0 AS (SELECT i, country, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM ids LEFT JOIN cnt USING (i)),
per AS (SELECT *, {_F} AS f FROM per0)"""
_SUMMARY = """
SELECT coalesce(country, 'ALL') AS country, count(*) AS n, round(avg(f), 6) AS macro_f05, round(avg(f) FILTER (n_true = 0), 6) AS singleton_f05, round(avg(f) FILTER (n_true > 0), 6) AS multi_f05,
  round(sum(tp) / greatest(sum(n_pred), 1), 6) AS micro_p, round(sum(tp) / greatest(sum(n_true), 1), 6) AS micro_r,
  round(avg(CAST(n_pred = 0 AS DOUBLE)), 6) AS empty_share, round(avg(CAST(n_true = 0 AS DOUBLE)), 6) AS singleton_share FROM per GROUP BY GROUPING SETS ((country), ())"""


def _labelled(s, f):
    t = truth(s, f).select("i", "j", F.lit(1).alias("y"))
    return scores(s, f).join(t, ["i", "j"], "left").na.fill(0, ["y"])


LABELLED = SCORES + ", lab AS (SELECT s.*, CASE WHEN t.i IS NULL THEN 0 ELSE 1 END AS y FROM scores s LEFT JOIN truth t ON s.i = t.i AND s.j = t.j)"


def _grid(s, f):
    x = scores(s, f).select("i", "j", "p")
    return ev.threshold_grid(s, ids(s, f), {m: dec.one_owner(x, m) for m in ("none", "hard")}, truth(s, f), TAUS)


_GRID_SQL = SCORES + OWNED + f""",
taus AS (SELECT unnest({TAUS}) AS tau), modes AS (SELECT unnest(['none', 'hard']) AS mode),
alls AS (SELECT 'none' AS mode, i, j, p FROM scores UNION ALL SELECT 'hard', i, j, p FROM owned),
nt AS (SELECT i, count(*) AS n_true FROM truth GROUP BY i),
gg AS (SELECT m.mode, t.tau, d.i, coalesce(n.n_true, 0) AS n_true,
   (SELECT count(*) FROM alls a WHERE a.mode = m.mode AND a.i = d.i AND a.p >= t.tau) AS n_pred,
   (SELECT count(*) FROM alls a JOIN truth x ON a.i = x.i AND a.j = x.j WHERE a.mode = m.mode AND a.i = d.i AND a.p >= t.tau) AS tp
  FROM modes m CROSS JOIN taus t CROSS JOIN ids d LEFT JOIN nt n USING (i))
SELECT mode, CAST(tau AS DOUBLE) AS tau, round(avg({_F}), 6) AS macro_f05, round(sum(tp) / greatest(sum(n_pred), 1), 6) AS micro_p, round(sum(tp) / greatest(sum(n_true), 1), 6) AS micro_r FROM gg GROUP BY mode, tau"""

_RECALL_SQL = SCORES + """,
tt AS (SELECT t.i, t.j, t.src, d.country, c.r_all FROM truth t JOIN ids d USING (i) LEFT JOIN cand c ON c.i = t.i AND c.j = t.j),
en AS (SELECT i, bool_and(r_all IS NOT NULL) AS hit FROM tt GROUP BY i)
SELECT 'pair' AS measure, 'all' AS slice, round(avg(CAST(r_all IS NOT NULL AS DOUBLE)), 6) AS value FROM tt
UNION ALL SELECT 'source', CAST(src AS VARCHAR), round(avg(CAST(r_all IS NOT NULL AS DOUBLE)), 6) FROM tt GROUP BY src
UNION ALL SELECT 'country', country, round(avg(CAST(r_all IS NOT NULL AS DOUBLE)), 6) FROM tt GROUP BY country
UNION ALL SELECT 'entity', 'all', round(avg(CAST(hit AS DOUBLE)), 6) FROM en
UNION ALL SELECT 'rank', CAST(k AS VARCHAR), round(avg(CAST(coalesce(r_all <= k, false) AS DOUBLE)), 6) FROM tt CROSS JOIN (SELECT unnest([5, 10, 20, 40]) AS k) GROUP BY k"""

_TAX = LABELLED + """,
tx AS (SELECT l.i, l.j, l.p, l.p >= 0.75 AS pred, l.y = 1 AS truth, coalesce(n.n_true, 0) AS n_true, sum(CASE WHEN l.p >= 0.75 AND l.y = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY l.i) AS n_tp
  FROM lab l LEFT JOIN (SELECT i, count(*) AS n_true FROM truth GROUP BY i) n USING (i)),
errors AS (SELECT i, j, p, CASE WHEN pred AND n_true = 0 THEN 'singleton_fp' WHEN pred THEN 'multi_fp' WHEN p >= 0.5 THEN 'rejected' WHEN n_tp > 0 THEN 'missed_extra' ELSE 'scored_low' END AS cat FROM tx WHERE pred <> truth)"""


_SHAPLEY_SQL = _TAX.replace(SCORES, SCORES + ", chosen AS (SELECT i, j FROM scores WHERE p >= 0.75)" + PER, 1) + f""",
ek AS (SELECT i, cat, count(*) AS c FROM errors GROUP BY i, cat),
kinds AS (SELECT * FROM (VALUES ('singleton_fp', 1, 0, -1), ('multi_fp', 2, 0, -1), ('rejected', 4, 1, 1), ('missed_extra', 8, 1, 1), ('scored_low', 16, 1, 1)) k(cat, bit, hits, size)),
masks AS (SELECT CAST(unnest(range(32)) AS INTEGER) AS mask),
am AS (SELECT per.i, mask, n_true, tp + coalesce(sum(c * hits) FILTER (mask & bit <> 0), 0) AS tp, n_pred + coalesce(sum(c * size) FILTER (mask & bit <> 0), 0) AS n_pred
  FROM per JOIN ek USING (i) JOIN kinds USING (cat) CROSS JOIN masks GROUP BY per.i, mask, n_true, tp, n_pred),
fm AS (SELECT i, mask, {_F} AS f FROM am)
SELECT e.i, e.cat, round(sum((b.f - a.f) / CASE bit_count(a.mask) WHEN 0 THEN 5 WHEN 1 THEN 20 WHEN 2 THEN 30 WHEN 3 THEN 20 ELSE 5 END), 6) AS loss
FROM ek e JOIN kinds k USING (cat) JOIN fm a ON a.i = e.i AND a.mask & k.bit = 0 JOIN fm b ON b.i = e.i AND b.mask = a.mask | k.bit GROUP BY e.i, e.cat"""


def _tags(s, f):
    p = pair_records(_cand(s, f).select("i", "j"), documents(s, f))
    same, lg = F.col("name_core") == F.col("name_core_b"), legal_skeleton("name_n", "script") != legal_skeleton("name_n_b", "script_b")
    tests = {"same_name": same, "same_addr": (F.col("addr_n") == F.col("addr_n_b")) & (F.col("addr_n") != ""), "phon_collide": (skeletons(F.col("name_core")) == skeletons(F.col("name_core_b"))) & ~same, "legal_collide": same & lg, "native": F.col("script_b") == 2}
    return p.select("i", "j", *(t.cast("int").alias(k) for k, t in tests.items()))


_TAGS = ["same_name", "same_addr", "phon_collide", "legal_collide", "native"]
_TAGS_SQL = f""",
tags AS (SELECT c.i, c.j, CAST(a.name_core = b.name_core AS INTEGER) AS same_name, CAST(a.addr_n = b.addr_n AND a.addr_n <> '' AS INTEGER) AS same_addr,
  CAST({sql.skeletons('a.name_core')} = {sql.skeletons('b.name_core')} AND a.name_core <> b.name_core AS INTEGER) AS phon_collide,
  CAST(a.name_core = b.name_core AND {sql.legal('a.name_n', 'a.script')} <> {sql.legal('b.name_n', 'b.script')} AS INTEGER) AS legal_collide, CAST(b.script = 2 AS INTEGER) AS native
  FROM cand c JOIN norm a ON a.eid = c.i JOIN norm b ON b.eid = c.j)"""


def _hard_cases(s, f):
    d = _labelled(s, f).join(_tags(s, f), ["i", "j"]).withColumn("pred", (F.col("p") >= 0.75).cast("int"))
    long = d.select("y", "pred", F.explode(F.array(*(F.struct(F.lit(t).alias("tag"), F.col(t).alias("on")) for t in _TAGS))).alias("t")).where("t.on = 1")
    hit = F.sum(F.col("pred") * F.col("y"))
    return long.groupBy("t.tag").agg(F.count("*").alias("pairs"), F.round(F.avg("y"), 6).alias("pos_rate"), F.round(hit / F.greatest(F.sum("pred"), F.lit(1)), 6).alias("precision"), F.round(hit / F.greatest(F.sum("y"), F.lit(1)), 6).alias("recall"))


_HARD_SQL = LABELLED + _TAGS_SQL + f""",
lt AS (SELECT l.y, CAST(l.p >= 0.75 AS INTEGER) AS pred, t.* FROM lab l JOIN tags t ON l.i = t.i AND l.j = t.j),
lg AS ({" UNION ALL ".join(f"SELECT '{t}' AS tag, y, pred FROM lt WHERE {t} = 1" for t in _TAGS)})
SELECT tag, count(*) AS pairs, round(avg(y), 6) AS pos_rate, round(sum(pred * y) / greatest(sum(pred), 1), 6) AS precision, round(sum(pred * y) / greatest(sum(y), 1), 6) AS recall FROM lg GROUP BY tag"""


def _blend_grid(s, f):
    second = scores(s, f).where(F.col("p").between(0.2, 0.9)).select("i", "j", F.round(1 - F.col("p") * 0.9, 6).alias("ce"))
    tables = {f"w{w}": dec.blend(scores(s, f).select("i", "j", "p"), second, w).withColumn("p", F.round("p", 6)) for w in (0.5, 0.8)}
    return ev.threshold_grid(s, ids(s, f), tables, truth(s, f), [0.3, 0.7])


_BLEND_GRID_SQL = SCORES + f""",
second AS (SELECT i, j, round(1 - p * 0.9, 6) AS ce FROM scores WHERE p BETWEEN 0.2 AND 0.9),
lo AS (SELECT s.i, s.j, p, ce, least(greatest(p, 1e-6), 1 - 1e-6) AS a, least(greatest(ce, 1e-6), 1 - 1e-6) AS b FROM scores s LEFT JOIN second USING (i, j)),
ws AS (SELECT unnest(@W) AS w), taus AS (SELECT unnest(@T) AS tau),
bl AS (SELECT w, i, j, round(CASE WHEN ce IS NULL THEN p ELSE 1 / (1 + exp(-(w * ln(a / (1 - a)) + (1 - w) * ln(b / (1 - b))))) END, 6) AS p FROM lo CROSS JOIN ws),
nt AS (SELECT i, count(*) AS n_true FROM truth GROUP BY i),
ch AS (SELECT b.w, t.tau, b.i, count(*) AS n_pred, count(x.j) AS tp FROM bl b JOIN taus t ON b.p >= t.tau LEFT JOIN truth x ON x.i = b.i AND x.j = b.j GROUP BY ALL),
pr0 AS (SELECT ws.w, taus.tau, d.i, d.country, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM ids d CROSS JOIN ws CROSS JOIN taus LEFT JOIN nt ON nt.i = d.i LEFT JOIN ch ON ch.w = ws.w AND ch.tau = taus.tau AND ch.i = d.i),
pr AS (SELECT *, {_F} AS f FROM pr0)"""


def _blend_sql(weights, taus) -> str:
    return _BLEND_GRID_SQL.replace("@W", str(weights)).replace("@T", str(taus))


#: The reference's grid of blend weights and thresholds.
WEIGHTS, BLEND_TAUS = [1.0, 0.8, 0.6, 0.5, 0.4, 0.2, 0.0], [0.5, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85]


def _cross_fitted(s, f):
    second = scores(s, f).where(F.col("p").between(0.2, 0.9)).select("i", "j", F.round(1 - F.col("p") * 0.9, 6).alias("ce"))
    return ev.cross_fitted_blend(s, ids(s, f), scores(s, f).select("i", "j", "p"), second, truth(s, f), WEIGHTS, BLEND_TAUS, 17)


_CROSS_SQL = _blend_sql(WEIGHTS, BLEND_TAUS) + f""",
hf AS (SELECT CAST(w AS DOUBLE) AS w, CAST(tau AS DOUBLE) AS tau, CASE WHEN substr(md5('17:' || i), 1, 12) < '{16**12 // 2:012x}' THEN 'a' ELSE 'b' END AS half, round(avg(f), 6) AS m FROM pr GROUP BY ALL),
cf AS (SELECT e.half, e.w, e.tau, o.m AS fitted, e.m AS held_out FROM hf e JOIN hf o ON o.w = e.w AND o.tau = e.tau AND o.half <> e.half),
b1 AS (SELECT * FROM cf QUALIFY row_number() OVER (PARTITION BY half ORDER BY fitted DESC, w DESC, tau) = 1),
b0 AS (SELECT half, held_out AS alone FROM cf WHERE w = 1 QUALIFY row_number() OVER (PARTITION BY half ORDER BY fitted DESC, tau) = 1)
SELECT half, w, tau, fitted, held_out, alone FROM b1 JOIN b0 USING (half)"""

MIX = {"de": 0.5, "en": 0.3, "es": 0.2}


def _sweep(s, f):
    x = scores(s, f).select("i", "j", "p")
    tables = {m: dec.one_owner(x, m).withColumn("p", F.round("p", 9)) for m in ("none", "hard", "soft")}
    return ev.threshold_sweep(s, ids(s, f), tables, truth(s, f), TAUS, MIX)


_SWEEP_SQL = SCORES + OWNED + f""",
taus AS (SELECT unnest({TAUS}) AS tau), modes AS (SELECT unnest(['none', 'hard', 'soft']) AS mode),
alls AS (SELECT 'none' AS mode, i, j, p FROM scores UNION ALL SELECT 'hard', i, j, p FROM owned UNION ALL SELECT 'soft', i, j, round(p / greatest(1.0, sum(p) OVER (PARTITION BY j)), 9) FROM scores),
nt AS (SELECT i, count(*) AS n_true FROM truth GROUP BY i),
ch AS (SELECT mode, tau, a.i, count(*) AS n_pred, count(x.j) AS tp FROM alls a JOIN taus t ON a.p >= t.tau LEFT JOIN truth x ON x.i = a.i AND x.j = a.j GROUP BY ALL),
g0 AS (SELECT m.mode, t.tau, d.i, d.country, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp
  FROM modes m CROSS JOIN taus t CROSS JOIN ids d LEFT JOIN nt ON nt.i = d.i LEFT JOIN ch ON ch.mode = m.mode AND ch.tau = t.tau AND ch.i = d.i),
gf AS (SELECT *, {_F} AS f FROM g0),
mx AS (SELECT mode, tau, country, avg(f) * CASE country WHEN 'de' THEN 0.5 WHEN 'en' THEN 0.3 ELSE 0.2 END AS part FROM gf WHERE country IN ('de', 'en', 'es') GROUP BY mode, tau, country)
SELECT mode, CAST(tau AS DOUBLE) AS tau, coalesce(country, 'ALL') AS slice, round(avg(f), 6) AS macro_f05, round(sum(tp) / greatest(sum(n_pred), 1), 6) AS micro_p, round(sum(tp) / greatest(sum(n_true), 1), 6) AS micro_r
FROM gf GROUP BY GROUPING SETS ((mode, tau), (mode, tau, country))
UNION ALL SELECT mode, CAST(tau AS DOUBLE), 'MIX', round(sum(part), 6), NULL, NULL FROM mx GROUP BY mode, tau"""


def _drawn(value: str, table: str, rounds: int = 2000, group: str = "country") -> str:
    """Means of md5-drawn Poisson resamples of a table (i, country, value)."""
    weight = " + ".join(f"CAST(u >= '{x}' AS INTEGER)" for x in ev.poisson_bounds())
    return f"""bu AS (SELECT country, r, f, substr(md5('0:' || i || ':' || r), 1, 8) AS u FROM (SELECT i, country, {value} AS f, unnest(range(1, {rounds + 1})) AS r FROM {table})),
bw AS (SELECT country, r, f, {weight} AS w FROM bu),
bm AS (SELECT country, r, sum(w * f) / sum(w) AS m FROM bw WHERE w > 0 GROUP BY country, r)"""


_INTERVAL = "SELECT country, round(quantile_cont(m, 0.025), 6) AS lo, round(quantile_cont(m, 0.975), 6) AS hi FROM bm GROUP BY country"
_PAIRED_SQL = CHOSEN + PER + f""",
chosen2 AS (SELECT i, j FROM owned WHERE p >= 0.5),
cnt2 AS (SELECT coalesce(t.i, c.i) AS i, count(t.j) AS n_true, count(c.j) AS n_pred, count(*) FILTER (t.j IS NOT NULL AND c.j IS NOT NULL) AS tp FROM (SELECT i, j FROM truth) t FULL JOIN chosen2 c ON t.i = c.i AND t.j = c.j GROUP BY ALL),
per2 AS (SELECT i, {_F} AS f2 FROM (SELECT i, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM ids LEFT JOIN cnt2 USING (i))),
dif AS (SELECT i, country, f - f2 AS d FROM per JOIN per2 USING (i)), {_drawn('d', 'dif')} {_INTERVAL}"""
_REWEIGHTED_SQL = CHOSEN + PER + f""",
sub AS (SELECT i, country, f, CASE country WHEN 'de' THEN 0.5 WHEN 'en' THEN 0.3 ELSE 0.2 END AS share FROM per WHERE country IN ('de', 'en', 'es')), {_drawn('f', 'sub')},
sh AS (SELECT DISTINCT country, share FROM sub), rm AS (SELECT r, sum(share * m) AS m FROM bm JOIN sh USING (country) GROUP BY r)
SELECT (SELECT round(sum(a * share), 6) FROM (SELECT country, avg(f) AS a FROM sub GROUP BY country) JOIN sh USING (country)) AS value, round(quantile_cont(m, 0.025), 6) AS lo, round(quantile_cont(m, 0.975), 6) AS hi FROM rm"""


def _strata(s, f):
    return sp.buckets(ids(s, f), truth(s, f))


STRATA = f"""WITH {DOCUMENTS_SQL},
docs AS (SELECT 1 + doc_id % 3 AS src, (1 + doc_id % 3) * 1000000000000 + doc_id AS eid, lower(text) AS h FROM documents WHERE text IS NOT NULL),
truth AS (SELECT a.eid AS i, b.eid AS j, b.src FROM docs a JOIN docs b ON a.h = b.h AND a.src = 1 AND b.src > 1),
ids AS (SELECT eid AS i, country FROM rec WHERE src = 1),
strata AS (SELECT ids.i, country, CAST(least(count(t.j), 3) AS INTEGER) AS bucket FROM ids LEFT JOIN truth t ON t.i = ids.i GROUP BY ALL)"""


def _md5(seed, x="i"):
    return f"substr(md5('{seed}:' || {x}), 1, 12)"


def _sample(s, f):
    d = ids(s, f)
    return sp.train_sample(d, d.where(sp.in_sample(11, 20)), d.where(sp.in_sample(12, 10)), 120, 13)


def _weights(s, f):
    d = scores(s, f).select("i", "j", "country", "src")
    return sp.stratified_weights(d, ["country", "src"], 500, 20, 9)


def _id_file(s, f):
    """Lists with faults of every kind, made by rule from the ids."""
    d = _lists_text(s, f)
    n = F.col("k") % 10
    bad = F.when(n == 1, F.concat_ws(",", "ids", F.lit("S2-77,S2-77"))).when(n == 2, F.concat_ws(",", "ids", "id")).when(n == 3, F.concat_ws(",", "ids", F.lit("X9-1"))).otherwise(F.col("ids"))
    out = d.where(n != 4).select("id", bad.alias("ids"))
    return out.unionByName(d.where(n == 5).select("id", "ids")).unionByName(s.createDataFrame([("S1-999999999", "")], "id string, ids string"))


def _lists_text(s, f):
    lists = dec.every(ids(s, f), _chosen(s, f))
    return val.written_ids(lists).withColumn("k", F.regexp_extract("id", "-(.*)", 1).cast("long"))


def _validate(s, f):
    wanted = ids(s, f).select(decode_id(F.col("i")).alias("id"))
    known = documents(s, f).where("src in (2, 3)").select(decode_id(F.col("eid")).alias("id"))
    return val.validate(_id_file(s, f), wanted, known)


_DEC = "'S' || {0} // 1000000000000 || '-' || {0} % 1000000000000"
_VALIDATE_SQL = CHOSEN.replace("chosen AS (SELECT i, j, src FROM", "chosen AS (SELECT i, j, src, p FROM") + f""",
li AS (SELECT ids.i % 1000000000000 AS k, {_DEC.format('ids.i')} AS id, coalesce(string_agg({_DEC.format('j')}, ',' ORDER BY p DESC, j) FILTER (j IS NOT NULL), '') AS ids FROM ids LEFT JOIN chosen USING (i) GROUP BY ids.i),
fl AS (SELECT id, CASE k % 10 WHEN 1 THEN ids || ',S2-77,S2-77' WHEN 2 THEN ids || ',' || id WHEN 3 THEN ids || ',X9-1' ELSE ids END AS ids FROM li WHERE k % 10 <> 4
  UNION ALL SELECT id, ids FROM li WHERE k % 10 = 5 UNION ALL SELECT 'S1-999999999', ''),
ls AS (SELECT id, list_filter(list_transform(string_split(ids, ','), lambda z: trim(z)), lambda z: z <> '') AS l FROM fl),
pp AS (SELECT id, unnest(l) AS c FROM ls),
wanted AS (SELECT {_DEC.format('i')} AS id FROM ids), known AS (SELECT {_DEC.format('eid')} AS id FROM norm WHERE src IN (2, 3))
SELECT 'duplicate_row' AS finding, count(*) AS n FROM (SELECT id FROM fl GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_in_list', count(*) FROM ls WHERE len(l) > len(list_distinct(l))
UNION ALL SELECT 'self_match', count(*) FROM pp WHERE id = c
UNION ALL SELECT 'bad_prefix', count(*) FROM pp WHERE NOT regexp_matches(c, '^S[23]-')
UNION ALL SELECT 'missing', count(*) FROM wanted WHERE id NOT IN (SELECT id FROM fl)
UNION ALL SELECT 'extra', count(*) FROM (SELECT DISTINCT id FROM fl) WHERE id NOT IN (SELECT id FROM wanted)
UNION ALL SELECT 'unknown_id', count(*) FROM pp WHERE c NOT IN (SELECT id FROM known)"""


def _substitutions(s, f):
    d = _cand(s, f).select("i", "j").join(documents(s, f).select(F.col("eid").alias("i"), F.col("name_n").alias("a")), "i").join(documents(s, f).select(F.col("eid").alias("j"), F.col("name_n").alias("b")), "j")
    return prof.substitutions(d, "a", "b")


_TOK = sql.toks("{0}")


def _fuzzy_evidence(s, f):
    p = pair_records(truth(s, f).select("i", "j"), documents(s, f))
    w = fuzzy_features(p).withColumn("w", F.lit(1.0)).withColumn("nm_tsort", F.round("nm_tsort", 4))
    return prof.weighted_quantiles(w, "country", "nm_tsort", "w")


def _variants(s, f):
    records = documents(s, f)
    idf = token_idf(records)
    cand = _cand(s, f).join(records.select(F.col("eid").alias("i"), "country"), "i").select("i", "j", "country", "s_name", "s_all", "n_fam")
    table = cand.join(idf.groupBy("country").agg(F.max("idf").alias("ln_n")), "country")
    ranked = ev.feature_variants(table, ["s_name", "s_all"], {"families": ["n_fam"]})["rank"]
    return ranked.select("i", "j", "country", "s_name", "s_all")


def _gbt(s, f):
    c = ["s_name", "s_addr", "s_mix", "s_all", "n_fam", "r_all"]
    d = _cand(s, f).join(truth(s, f).select("i", "j", F.lit(1).alias("y")), ["i", "j"], "left").na.fill(0, ["y"])
    d = d.join(sp.folds(_strata(s, f), 2, 3).select("i", "fold"), "i").select("i", "j", "y", "fold", *(F.col(x).cast("double") for x in c))
    return learn.out_of_fold(d, c, [0, 1], rounds=4, depth=3).withColumn("p", F.round("p", 6))


def _isotonic(s, f):
    d = _labelled(s, f).join(sp.folds(_strata(s, f), 3, 3).select("i", "fold"), "i").select("i", "j", "src", "fold", "p", "y")
    return learn.calibrate(d.withColumn("src", F.col("src").cast("int"))).select("i", "j", "fold", "p", F.round("q", 6).alias("q"))


#: Pooled values as the largest, over starts up to a score, of the least mean over ends from it on.
_ISOTONIC_SQL = LABELLED + f""",
nb AS (SELECT ids.i, country, CAST(least(count(t.j), 3) AS INTEGER) AS bucket FROM ids LEFT JOIN truth t ON t.i = ids.i GROUP BY ALL),
fo AS (SELECT i, CAST((row_number() OVER (PARTITION BY country, bucket ORDER BY {_md5(3)}, i) - 1) % 3 AS INTEGER) AS fold FROM nb),
sc AS (SELECT l.i, l.j, l.src, fold, l.p, l.y FROM lab l JOIN fo USING (i)),
fs AS (SELECT DISTINCT fold FROM sc),
gr AS (SELECT f.fold, src, p AS x, count(*) AS n, sum(y) AS s FROM sc JOIN fs f ON f.fold <> sc.fold GROUP BY ALL),
cu AS (SELECT *, row_number() OVER w AS r, sum(n) OVER w AS cn, sum(s) OVER w AS cs FROM gr WINDOW w AS (PARTITION BY fold, src ORDER BY x)),
av AS (SELECT a.fold, a.src, a.r AS ra, b.r AS rb, (b.cs - a.cs + a.s) / (b.cn - a.cn + a.n) AS m FROM cu a JOIN cu b ON a.fold = b.fold AND a.src = b.src AND a.r <= b.r),
lm AS (SELECT fold, src, ra, rb, min(m) OVER (PARTITION BY fold, src, ra ORDER BY rb DESC) AS m FROM av),
pv AS (SELECT fold, src, rb AS r, max(m) AS v FROM lm GROUP BY ALL),
st AS (SELECT fold, src, x, v FROM pv JOIN cu USING (fold, src, r)),
hi AS (SELECT fold, src, max(x) AS top FROM st GROUP BY ALL),
pk AS (SELECT sc.i, sc.j, sc.fold, sc.p, sc.src, min(st.x) AS x FROM sc LEFT JOIN st ON st.fold = sc.fold AND st.src = sc.src AND st.x >= sc.p GROUP BY ALL)
SELECT pk.i, pk.j, pk.fold, pk.p, round(coalesce(st.v, pk.p), 6) AS q FROM pk LEFT JOIN hi USING (fold, src) LEFT JOIN st ON st.fold = pk.fold AND st.src = pk.src AND st.x = coalesce(pk.x, hi.top)"""


def _knn(s, f):
    e = load(s, f, "embeddings")
    a, b = e.where("vec_id % 3 = 0"), e.where("vec_id % 3 <> 0")
    return top_k(a, b, "label", "vec_id", "embedding", 5).withColumn("cosine", F.round("cosine", 5))


def _knn_whole(s, f):
    e = load(s, f, "embeddings")
    return top_k(e.where("vec_id % 20 = 0"), e, "label", "vec_id", "embedding", 5).withColumn("cosine", F.round("cosine", 5))


_KNN_SQL = """
WITH a AS (SELECT vec_id, label, list_transform(embedding, lambda z: CAST(z AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT x.vec_id, y.vec_id AS other, list_dot_product(x.v, y.v) / sqrt(list_dot_product(x.v, x.v) * list_dot_product(y.v, y.v)) AS c
  FROM a x JOIN a y ON x.label = y.label WHERE x.vec_id % 3 = 0 AND y.vec_id % 3 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(c, 9) DESC, other) AS rank FROM s)
SELECT vec_id, other, rank, round(c, 5) AS cosine FROM r WHERE rank <= 5"""
_KNN_WHOLE_SQL = _KNN_SQL.replace("x.vec_id % 3 = 0 AND y.vec_id % 3 <> 0", "x.vec_id % 20 = 0 AND y.vec_id <> x.vec_id")

_EVIDENCE_SQL = sql.normalized() + STRATA[len(f"WITH {DOCUMENTS_SQL}"):]
_FIRST = _TOK.format("{0}.name_core") + "[1]"
_SHARE = "round(avg(CAST({0} AS DOUBLE)), 6)"

QUERIES = {
    "blocking_recall": (lambda s, f: ev.blocking_recall(truth(s, f), _cand(s, f), ids(s, f)), _RECALL_SQL),
    "oracle_ceiling": (lambda s, f: ev.summary(ev.oracle(ids(s, f), _cand(s, f), truth(s, f))).select("country", "n", "macro_f05"), SCORES + ", chosen AS (SELECT t.i, t.j FROM truth t JOIN cand c ON c.i = t.i AND c.j = t.j)" + PER + " SELECT coalesce(country, 'ALL') AS country, count(*) AS n, round(avg(f), 6) AS macro_f05 FROM per GROUP BY GROUPING SETS ((country), ())"),
    "macro_f05": (lambda s, f: ev.summary(_records(s, f)), CHOSEN + PER + _SUMMARY),
    "per_record_f05": (lambda s, f: _records(s, f).select("i", "country", "n_true", "n_pred", "tp", F.round("f", 6).alias("f")), CHOSEN + PER + " SELECT i, country, n_true, n_pred, tp, round(f, 6) AS f FROM per"),
    "tau_grid_owner": (_grid, _GRID_SQL),
    "blend_grid": (_blend_grid, _blend_sql([0.5, 0.8], [0.3, 0.7]) + " SELECT 'w' || w AS mode, CAST(tau AS DOUBLE) AS tau, round(avg(f), 6) AS macro_f05, round(sum(tp) / greatest(sum(n_pred), 1), 6) AS micro_p, round(sum(tp) / greatest(sum(n_true), 1), 6) AS micro_r FROM pr GROUP BY w, tau"),
    "blend_cross_fitted": (_cross_fitted, _CROSS_SQL),
    "tau_sweep_slices": (_sweep, _SWEEP_SQL),
    "ece_bins": (lambda s, f: ev.calibration_bins(_labelled(s, f)), LABELLED + ", eb AS (SELECT CAST(least(floor(p * 20), 19) AS BIGINT) AS bin, count(*) AS n, avg(p) AS mp, avg(y) AS my FROM lab GROUP BY 1) SELECT bin, n, round(mp, 6) AS mean_p, round(my, 6) AS mean_y, round(n / sum(n) OVER () * abs(mp - my), 6) AS ece_part FROM eb"),
    "error_taxonomy": (lambda s, f: ev.label_errors(scores(s, f), truth(s, f), 0.75), _TAX + " SELECT i, j, p, cat FROM errors"),
    "error_pivot": (lambda s, f: ev.label_errors(scores(s, f), truth(s, f), 0.75).join(ids(s, f), "i").groupBy("cat").pivot("country", ["de", "en", "es", "fr"]).agg(F.count(F.lit(1))).na.fill(0), _TAX + " SELECT cat, " + ", ".join(f"count(*) FILTER (country = '{c}') AS {c}" for c in ("de", "en", "es", "fr")) + " FROM errors JOIN ids USING (i) GROUP BY cat"),
    "pair_tags": (_tags, sql.blocked(CAPPED) + _TAGS_SQL + " SELECT i, j, " + ", ".join(_TAGS) + " FROM tags"),
    "hard_cases": (_hard_cases, _HARD_SQL),
    "auc_ap": (lambda s, f: ev.auc_ap(_labelled(s, f)), LABELLED + ", g AS (SELECT p, sum(y) AS pos, count(*) AS n FROM lab GROUP BY p), w AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(n) OVER (ORDER BY p DESC) AS seen FROM g) SELECT round(sum((n - pos) * (tp - pos / 2)) / (sum(pos) * sum(n - pos)), 6) AS auc, round(sum(pos * tp / seen) / sum(pos), 6) AS ap FROM w"),
    "pct_rank_country": (lambda s, f: ev.percent_rank(scores(s, f), "p").select("i", "j", "country", "pct"), SCORES + " SELECT i, j, country, round((rank() OVER (PARTITION BY country ORDER BY p) + (count(*) OVER (PARTITION BY country, p) - 1) / 2.0) / count(*) OVER (PARTITION BY country), 6) AS pct FROM scores"),
    "reweighted_f05": (lambda s, f: ev.reweighted(_records(s, f), MIX), _REWEIGHTED_SQL),
    "feature_variant_rank": (_variants, SCORES + ", c AS (SELECT i, j, country, s_name, s_all FROM cand JOIN ids USING (i)) SELECT i, j, country, " + ", ".join(f"round((rank() OVER (PARTITION BY country ORDER BY {x}) + (count(*) OVER (PARTITION BY country, {x}) - 1) / 2.0) / count(*) OVER (PARTITION BY country), 6) AS {x}" for x in ("s_name", "s_all")) + " FROM c"),
    "eda_fuzzy_evidence": (_fuzzy_evidence, None),
    "shapley_losses": (lambda s, f: ev.shapley_losses(ids(s, f), scores(s, f), truth(s, f), 0.75).withColumn("loss", F.round("loss", 6)), _SHAPLEY_SQL),
    "bootstrap_ci": (lambda s, f: ev.bootstrap(_records(s, f)), CHOSEN + PER + f", {_drawn('f', 'per')} {_INTERVAL}"),
    "paired_bootstrap": (lambda s, f: ev.paired_bootstrap(_records(s, f), ev.per_record(ids(s, f), _chosen(s, f, 0.5).select("i", "j"), truth(s, f))), _PAIRED_SQL),
    "folds_stratified": (lambda s, f: sp.folds(_strata(s, f), 5, 42), STRATA + f" SELECT i, country, bucket, CAST((row_number() OVER (PARTITION BY country, bucket ORDER BY {_md5(42)}, i) - 1) % 5 AS INTEGER) AS fold FROM strata"),
    "loco_folds": (lambda s, f: sp.leave_one_country_out(_strata(s, f)).groupBy("held_out").agg(F.count("*").alias("n")), STRATA + " SELECT country AS held_out, count(*) AS n FROM strata GROUP BY country"),
    "hash_sample": (lambda s, f: ids(s, f).where(sp.in_sample(5, 7)), STRATA + f" SELECT i, country FROM ids WHERE {_md5(5)} < '{16**12 // 7:012x}'"),
    "lockbox_split": (lambda s, f: sp.lockbox(_strata(s, f), ids(s, f).where(sp.in_sample(5, 7)), 0.3, 2026), STRATA + f", pool AS (SELECT *, row_number() OVER (PARTITION BY country, bucket ORDER BY {_md5(2026)}, i) - 1 AS pos, count(*) OVER (PARTITION BY country, bucket) AS size FROM strata WHERE NOT ({_md5(5)} < '{16**12 // 7:012x}')) SELECT i, country, bucket FROM pool WHERE pos < round(size * 0.3)"),
    "strata_mix": (lambda s, f: sp.mix(_strata(s, f)), STRATA + " SELECT country, bucket, round(count(*) / sum(count(*)) OVER (), 4) AS share FROM strata GROUP BY country, bucket"),
    "train_sample": (_sample, STRATA + f", pool AS (SELECT i, CASE WHEN {_md5(11)} < '{16**12 // 20:012x}' THEN 0 ELSE 1 END AS late FROM ids WHERE NOT ({_md5(12)} < '{16**12 // 10:012x}')) SELECT i FROM pool ORDER BY late, {_md5(13)}, i LIMIT 120"),
    "band_sample": (lambda s, f: sp.band_sample(_labelled(s, f).select("i", "j", "p", "y"), 0.3, 0.6, 30, 50, 4), LABELLED + ", o AS (SELECT i, j, p, y, p BETWEEN 0.3 AND 0.6 AS band, substr(md5('4:' || i || ':' || j), 1, 12) AS t FROM lab), q AS (SELECT *, row_number() OVER (PARTITION BY band, y ORDER BY t, i, j) AS r FROM o) SELECT i, j, p, y, CASE WHEN band THEN 'hard' WHEN y = 1 THEN 'easy_pos' ELSE 'easy_neg' END AS part FROM q WHERE band OR r <= CASE WHEN y = 1 THEN 30 ELSE 50 END"),
    "stratified_weights": (_weights, SCORES + ", q AS (SELECT i, j, country, src, count(*) OVER (PARTITION BY country, src) AS n, count(*) OVER () AS total, row_number() OVER (PARTITION BY country, src ORDER BY substr(md5('9:' || i || ':' || j), 1, 12), i, j) AS r FROM scores), k AS (SELECT *, least(n, greatest(round(500 * n / total), 20)) AS take FROM q) SELECT i, j, country, src, round(n / take, 6) AS weight FROM k WHERE r <= take"),
    "validate_idlist": (_validate, _VALIDATE_SQL),
    "eda_missing": (lambda s, f: prof.missing(documents(s, f)), sql.normalized() + " SELECT src, country, count(*) AS n, " + ", ".join(f"round(avg(CAST({c} = '' AS DOUBLE)), 6) AS {c}" for c in ("name_raw", "addr_raw", "name_core", "addr_n", "addr_nums")) + " FROM norm GROUP BY src, country"),
    "eda_uniqueness": (lambda s, f: prof.uniqueness(documents(s, f)), sql.normalized() + ", g AS (SELECT src, name_core, count(*) AS n FROM norm GROUP BY ALL) SELECT src, count(*) AS n_values, round(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n), 6) AS unique_share, count(*) FILTER (n >= 10) AS groups_10 FROM g GROUP BY src"),
    "eda_match_pattern": (lambda s, f: prof.match_pattern(ids(s, f), truth(s, f)), STRATA + ", n AS (SELECT ids.i, country, count(*) FILTER (t.src = 2) AS n2, count(*) FILTER (t.src = 3) AS n3 FROM ids LEFT JOIN truth t ON t.i = ids.i GROUP BY ALL) SELECT country, CASE WHEN n2 > 0 AND n3 > 0 THEN 'both' WHEN n2 > 0 THEN 's2' WHEN n3 > 0 THEN 's3' ELSE 'none' END AS pattern, least(n2 + n3, 3) AS matches, count(*) AS n FROM n GROUP BY 1, 2, 3"),
    "eda_orphans": (lambda s, f: prof.orphans(documents(s, f), truth(s, f)), STRATA + ", o AS (SELECT r.src, r.eid, count(DISTINCT t.i) AS owners FROM rec r LEFT JOIN truth t ON t.j = r.eid WHERE r.src IN (2, 3) GROUP BY ALL) SELECT src, count(*) AS n, count(*) FILTER (owners = 0) AS orphans, count(*) FILTER (owners > 1) AS shared, max(owners) AS most FROM o GROUP BY src"),
    "eda_lookalike": (lambda s, f: prof.look_alikes(documents(s, f), truth(s, f)), _EVIDENCE_SQL + ", b AS (SELECT country, name_core, eid AS j, count(*) OVER (PARTITION BY country, name_core) AS n FROM norm WHERE src IN (2, 3)) SELECT a.country, count(*) AS pairs, count(DISTINCT a.eid) AS records FROM norm a JOIN b ON a.country = b.country AND a.name_core = b.name_core AND b.n <= 50 WHERE a.src = 1 AND NOT EXISTS (SELECT 1 FROM truth t WHERE t.i = a.eid AND t.j = b.j) GROUP BY a.country"),
    "eda_evidence": (lambda s, f: prof.evidence(documents(s, f), truth(s, f)), _EVIDENCE_SQL + f", e AS (SELECT a.country, t.src, a.name_raw = b.name_raw AS e1, a.name_core = b.name_core AS e2, a.addr_n = b.addr_n AND a.addr_n <> '' AS e3, a.addr_nums = b.addr_nums AND a.addr_nums <> '' AS e4, coalesce({_FIRST.format('a')} = {_FIRST.format('b')}, false) AS e5 FROM truth t JOIN norm a ON a.eid = t.i JOIN norm b ON b.eid = t.j) SELECT country, src, count(*) AS n, {_SHARE.format('e1')} AS same_raw_name, {_SHARE.format('e2')} AS same_core, {_SHARE.format('e3')} AS same_addr, {_SHARE.format('e4')} AS same_nums, {_SHARE.format('e5')} AS same_first_token, {_SHARE.format('NOT (e1 OR e2 OR e3 OR e4 OR e5)')} AS no_evidence FROM e GROUP BY country, src"),
    "eda_corroboration": (lambda s, f: prof.corroboration(documents(s, f), truth(s, f)), _EVIDENCE_SQL + f", c AS (SELECT x.name_core = y.name_core AS n, x.addr_n = y.addr_n AS a FROM truth t JOIN truth u ON t.i = u.i AND t.src = 2 AND u.src = 3 JOIN norm x ON x.eid = t.j JOIN norm y ON y.eid = u.j) SELECT count(*) AS triples, {_SHARE.format('n')} AS same_name, {_SHARE.format('a')} AS same_addr FROM c"),
    "mine_substitutions": (_substitutions, sql.blocked(CAPPED) + f", d AS (SELECT list_distinct({_TOK.format('a.name_n')}) AS ta, list_distinct({_TOK.format('b.name_n')}) AS tb FROM cand c JOIN norm a ON a.eid = c.i JOIN norm b ON b.eid = c.j), x AS (SELECT list_filter(ta, lambda z: NOT list_contains(tb, z)) AS x, list_filter(tb, lambda z: NOT list_contains(ta, z)) AS y FROM d) SELECT x[1] AS from_token, y[1] AS to_token, count(*) AS n FROM x WHERE len(x) = 1 AND len(y) = 1 GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 40"),
    "weighted_quantile": (lambda s, f: prof.weighted_quantiles(scores(s, f).withColumn("w", (1 + F.col("j") % 5).cast("double")), "country", "p", "w"), SCORES + ", g AS (SELECT country, p, sum(1.0 + j % 5) AS w FROM scores GROUP BY ALL), r AS (SELECT *, sum(w) OVER (PARTITION BY country ORDER BY p) AS run, sum(w) OVER (PARTITION BY country) AS tot FROM g) SELECT country, " + ", ".join(f"min(p) FILTER (run >= {q} * tot - 1e-9) AS q{round(q * 100)}" for q in (0.1, 0.5, 0.9)) + ", round(sum(CAST(w AS DOUBLE) * p) / sum(CAST(w AS DOUBLE)), 6) AS mean FROM r GROUP BY country"),
    "prediction_stats": (lambda s, f: prof.prediction_stats(ids(s, f), _chosen(s, f)), CHOSEN + ", n AS (SELECT ids.i, country, count(c.j) AS n, count(*) FILTER (c.src = 3) AS n3 FROM ids LEFT JOIN chosen c ON c.i = ids.i GROUP BY ALL) SELECT country, count(*) AS records, round(avg(CAST(n > 0 AS DOUBLE)), 6) AS matched_share, round(avg(n), 6) AS mean_matches, list_sort(list(n))[CAST(round(0.95 * (count(*) - 1)) AS INTEGER) + 1] AS p95, round(sum(n3) / greatest(sum(n), 1), 6) AS s3_share FROM n GROUP BY country"),
    "knn_embeddings": (_knn, _KNN_SQL),
    "knn_embeddings_whole": (_knn_whole, _KNN_WHOLE_SQL),
    "gbt_oof": (_gbt, None),
    "isotonic_calibration": (_isotonic, _ISOTONIC_SQL),
}
