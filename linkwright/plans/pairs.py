"""Queries of pair features and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.similarity import jaro_winkler_udf
from ..operators import blocking as block
from ..operators import decide as dec
from ..operators import features as feat
from . import sql
from .blocking import CAPPED, documents
from .records import load

_SETS = [f"{p}_{x}" for p in ("nt", "num", "lnum", "nnum") for x in ("common", "n_a", "n_b", "conflict", "ov_min")]
_META = ["script_diff", "web_any", "nm_first_eq", "num_first_eq", "nm_len_a", "nm_len_b", "ad_n_a", "ad_n_b"]
_IDF = [f"{k}_{x}" for k in ("name", "addr") for x in ("unm_a", "unm_b", "wov_min", "wov_max", "wjac", "wcommon")]


def _cand(spark, sf):
    return block.candidates(documents(spark, sf), CAPPED)


def _paired(spark, sf):
    return feat.pair_records(_cand(spark, sf), documents(spark, sf))


_PAIRED = sql.blocked(CAPPED) + """,
pr AS (SELECT c.*, a.country, a.script, a.name_n, a.name_core, a.name_alias, a.name_web, a.addr_n, a.addr_nums,
  b.src AS src_b, b.script AS script_b, b.name_n AS name_n_b, b.name_core AS name_core_b, b.name_alias AS name_alias_b, b.name_web AS name_web_b, b.addr_n AS addr_n_b, b.addr_nums AS addr_nums_b
  FROM cand c JOIN norm a ON a.eid = c.i JOIN norm b ON b.eid = c.j)"""


def _set_sql(a: str, b: str, p: str) -> str:
    both = f"len(list_filter(list_distinct({a}), lambda z: list_contains({b}, z)))"
    least = f"greatest(least(len({a}), len({b})), 1)"
    return f"""{both} AS {p}_common, len({a}) AS {p}_n_a, len({b}) AS {p}_n_b,
  CASE WHEN len({a}) > 0 AND len({b}) > 0 AND {both} = 0 THEN 1 ELSE 0 END AS {p}_conflict, round({both} / {least}, 6) AS {p}_ov_min"""


def _plain_sql(columns: list[str]) -> str:
    t = {c: sql.toks(c) for c in ("name_core", "name_core_b", "addr_nums", "addr_nums_b", "addr_n", "addr_n_b")}
    sets = ", ".join(
        (_set_sql(t["name_core"], t["name_core_b"], "nt"), _set_sql(t["addr_nums"], t["addr_nums_b"], "num"),
         _set_sql(*(f"list_filter({t[c]}, lambda z: length(z) >= 5)" for c in ("addr_nums", "addr_nums_b")), "lnum"),
         _set_sql(*(f"regexp_extract_all({c}, '[0-9]+')" for c in ("name_core", "name_core_b")), "nnum"))
    )
    return _PAIRED + f""",
pf AS (SELECT i, j, CASE WHEN script <> script_b THEN 1 ELSE 0 END AS script_diff, greatest(name_web, name_web_b) AS web_any,
  CASE WHEN {t['name_core']}[1] = {t['name_core_b']}[1] THEN 1 ELSE 0 END AS nm_first_eq,
  CASE WHEN {t['addr_nums']}[1] = {t['addr_nums_b']}[1] THEN 1 ELSE 0 END AS num_first_eq,
  length(name_core) AS nm_len_a, length(name_core_b) AS nm_len_b, len({t['addr_n']}) AS ad_n_a, len({t['addr_n_b']}) AS ad_n_b, {sets} FROM pr)
SELECT i, j, {", ".join(columns)} FROM pf"""


def _legal_sql() -> str:
    return _PAIRED + f""",
lg AS (SELECT i, j, {sql.legal('name_n', 'script')} AS lg_a, {sql.legal('name_n_b', 'script_b')} AS lg_b FROM pr)
SELECT i, j, CASE WHEN lg_a <> '' AND lg_b <> '' THEN 1 ELSE 0 END AS lg_both, CASE WHEN lg_a = lg_b THEN 1 ELSE 0 END AS lg_same,
  CASE WHEN lg_a <> '' AND lg_b <> '' AND lg_a <> lg_b THEN 1 ELSE 0 END AS lg_conflict FROM lg"""


def _idf_sql() -> str:
    parts = []
    for kind, a in (("name", "name_core"), ("addr", "addr_n")):
        parts.append(f""",
{kind}_t AS (SELECT i, j, country, unnest(list_distinct({sql.toks(a)})) AS t, 1 AS s FROM pr UNION ALL SELECT i, j, country, unnest(list_distinct({sql.toks(a + '_b')})), 2 FROM pr),
{kind}_w AS (SELECT x.i, x.j, x.t, sum(s) AS s, any_value(coalesce(f.idf, (SELECT max(idf) FROM idf WHERE kind = '{kind}'), 10.0)) AS v
  FROM {kind}_t x LEFT JOIN idf f ON f.kind = '{kind}' AND f.country = x.country AND f.t = x.t GROUP BY x.i, x.j, x.t),
{kind}_s AS (SELECT i, j, coalesce(sum(v) FILTER (s IN (1, 3)), 0) AS wa, coalesce(sum(v) FILTER (s IN (2, 3)), 0) AS wb, coalesce(sum(v) FILTER (s = 3), 0) AS wc,
  coalesce(max(v) FILTER (s = 1), 0) AS ua, coalesce(max(v) FILTER (s = 2), 0) AS ub FROM {kind}_w GROUP BY i, j),
{kind}_f AS (SELECT p.i, p.j, coalesce(ua, 0) AS {kind}_unm_a, coalesce(ub, 0) AS {kind}_unm_b, round(coalesce(wc, 0) / (least(coalesce(wa, 0), coalesce(wb, 0)) + 1e-6), 6) AS {kind}_wov_min,
  round(coalesce(wc, 0) / (greatest(coalesce(wa, 0), coalesce(wb, 0)) + 1e-6), 6) AS {kind}_wov_max, round(coalesce(wc, 0) / (coalesce(wa, 0) + coalesce(wb, 0) - coalesce(wc, 0) + 1e-6), 6) AS {kind}_wjac,
  round(coalesce(wc, 0), 6) AS {kind}_wcommon FROM pr p LEFT JOIN {kind}_s USING (i, j))""")
    return _PAIRED + sql.idf() + "".join(parts)


def _idf_features(spark, sf):
    c = _cand(spark, sf)
    return feat.idf_features(feat.pair_records(c, feat.sides(c, documents(spark, sf)))).select("i", "j", *_IDF)


def _scaled(spark, sf):
    records = documents(spark, sf)
    return feat.scaled(_cand(spark, sf).join(records.select(F.col("eid").alias("i"), "country"), "i").select("i", "j", "country", "s_name", "s_addr", "s_mix", "s_all"), feat.token_idf(records))


def _context(spark, sf):
    c = _cand(spark, sf).select("i", "j", "s_all", F.col("s_name").alias("n"))
    return feat.context_features(c, "n").select("i", "j", *_CONTEXT)


_CONTEXT = ["s1_n_cand", "s1_gap", "s1_ratio", "s1_nm_gap", "s1_nm_rank"]
_COMPETE = ["cand_n_s1", "cand_rank", "cand_ratio", "cand_nm_gap"]


def _compete(spark, sf):
    c = _cand(spark, sf).select("i", "j", "s_all", F.col("s_name").alias("n"))
    return feat.context_features(c, "n").select("i", "j", *_COMPETE)


_CONTEXT_SQL = sql.blocked(CAPPED) + """
SELECT i, j, count(*) OVER m AS s1_n_cand, round(max(s_all) OVER m - s_all, 6) AS s1_gap, round(s_all / max(s_all) OVER m, 6) AS s1_ratio,
  round(max(s_name) OVER m - s_name, 6) AS s1_nm_gap, rank() OVER (PARTITION BY i ORDER BY s_name DESC) AS s1_nm_rank FROM cand WINDOW m AS (PARTITION BY i)"""
_COMPETE_SQL = sql.blocked(CAPPED) + """
SELECT i, j, count(*) OVER m AS cand_n_s1, rank() OVER (PARTITION BY j ORDER BY s_all DESC) AS cand_rank, round(s_all / max(s_all) OVER m, 6) AS cand_ratio,
  round(max(s_name) OVER m - s_name, 6) AS cand_nm_gap FROM cand WINDOW m AS (PARTITION BY j)"""


# Scores that SQL can reproduce: a fixed logistic formula of the blocking scores.


def scores(spark, sf):
    """i, j, country, src, p and the truth y: equal lower-cased texts in different sources."""
    records = documents(spark, sf)
    names = records.select(F.col("eid").alias("i"), "country", F.col("name_core").alias("ca"), F.col("addr_n").alias("aa"))
    other = records.select(F.col("eid").alias("j"), F.col("src"), F.col("name_core").alias("cb"), F.col("addr_n").alias("ab"))
    c = _cand(spark, sf).join(names, "i").join(other, "j")
    z = -4.0 + 0.12 * F.col("s_all") + 0.35 * F.col("n_fam") + 1.5 * (F.col("ca") == F.col("cb")).cast("int") + 0.8 * (F.col("aa") == F.col("ab")).cast("int")
    return c.select("i", "j", "country", "src", F.round(1 / (1 + F.exp(-z)), 6).alias("p"))


def truth(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", F.sha2(F.lower("text"), 256).alias("h"))
    src = 1 + F.col("doc_id") % 3
    d = d.select((src * 10**12 + F.col("doc_id")).alias("eid"), src.alias("src"), "h")
    a = d.where("src = 1").select(F.col("eid").alias("i"), "h")
    return a.join(d.where("src > 1").select(F.col("eid").alias("j"), "src", "h"), "h").select("i", "j", "src")


def ids(spark, sf):
    return documents(spark, sf).where("src = 1").select(F.col("eid").alias("i"), "country")


SCORES = sql.blocked(CAPPED) + """,
scores AS (SELECT c.i, c.j, a.country, b.src, round(1 / (1 + exp(-(-4.0 + 0.12 * c.s_all + 0.35 * c.n_fam + 1.5 * CAST(a.name_core = b.name_core AS INTEGER) + 0.8 * CAST(a.addr_n = b.addr_n AS INTEGER)))), 6) AS p
  FROM cand c JOIN norm a ON a.eid = c.i JOIN norm b ON b.eid = c.j),
docs AS (SELECT 1 + doc_id % 3 AS src, (1 + doc_id % 3) * 1000000000000 + doc_id AS eid, lower(text) AS h FROM documents WHERE text IS NOT NULL),
truth AS (SELECT a.eid AS i, b.eid AS j, b.src FROM docs a JOIN docs b ON a.h = b.h AND a.src = 1 AND b.src > 1),
ids AS (SELECT eid AS i, country FROM norm WHERE src = 1)"""
OWNED = """,
owned AS (SELECT * REPLACE (CASE WHEN p >= max(p) OVER (PARTITION BY j) THEN p ELSE 0.0 END AS p) FROM scores)"""
LISTS = """
SELECT ids.i, coalesce(string_agg(CAST(j AS VARCHAR), ',' ORDER BY p DESC, j) FILTER (j IS NOT NULL), '') AS ids FROM ids LEFT JOIN {chosen} USING (i) GROUP BY ids.i"""


def _lists(ids_, chosen):
    return dec.every(ids_, chosen).select("i", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def _second(spark, sf):
    """A second score on the uncertain pairs, by a fixed formula."""
    return scores(spark, sf).where(F.col("p").between(0.2, 0.9)).select("i", "j", F.round(1 - F.col("p") * 0.9, 6).alias("ce"))


_BLEND = SCORES + ", second AS (SELECT i, j, round(1 - p * 0.9, 6) AS ce FROM scores WHERE p BETWEEN 0.2 AND 0.9), lo AS (SELECT s.i, s.j, p, ce, least(greatest(p, 1e-6), 1 - 1e-6) AS a, least(greatest(ce, 1e-6), 1 - 1e-6) AS b FROM scores s LEFT JOIN second USING (i, j)), mx AS (SELECT *, 1 / (1 + exp(-(0.6 * ln(a / (1 - a)) + 0.4 * ln(b / (1 - b))))) AS m FROM lo)"


def _rounded(d):
    return d.select("i", "j", F.round("p", 6).alias("p"))


def _soft(s, f):
    return _rounded(dec.one_owner(scores(s, f), "soft"))


def _ensemble(s, f):
    x = scores(s, f).select("i", "j", "p")
    return _rounded(dec.ensemble([x, x.withColumn("p", F.col("p") * 0.5), x.withColumn("p", F.col("p") * F.col("p"))]))


def _fuzzy(s, f):
    p = feat.fuzzy_features(_paired(s, f))
    return p.select("i", "j", *(F.round(c, 4).alias(c) for c in ("nm_ratio", "nm_tset", "nm_tsort", "nm_partial", "nm_jw", "nm_comp_jw", "nm_comp_partial", "nm_ph_ratio", "nm_ph_tset", "nm_full_tset", "ad_tset", "ad_partial_tset", "ad_ratio", "nm_alias_best")))


def _features_all(s, f):
    """Records, keys, candidates and sides are read more than once, so they are written; what only they are made from goes."""
    from ..llm.common import Work  # the catalogue itself must do without linkwright.llm

    work = Work(s, "pairs")
    # Edit scores take strings of equal length together, of which a batch must have many; a row has some thirty short texts.
    s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16384")
    s.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    records = work.save(documents(s, f), "records")
    keys = work.save(block.record_keys(records, CAPPED), "keys")
    work.tidy()
    c = work.save(block.candidates(records, CAPPED, keys), "candidates")
    work.clear("records", "candidates")
    written = work.save(feat.sides(c, records), "sides")
    work.clear("candidates", "sides")
    return feat.pair_features(c, written, written)


def _country_rule(s, f):
    records = documents(s, f)
    # Language codes are words of some names here, as country names are elsewhere.
    return _rounded(dec.country_word_rule(scores(s, f), records))


def _seen(s, f):
    seen, rest = dec.split_seen(documents(s, f), s.createDataFrame([("de",), ("en",)], "country string"))
    return seen.select("eid", F.lit("seen").alias("part")).unionByName(rest.select("eid", F.lit("unseen").alias("part")))


_EXPECTED_SQL = SCORES.replace("WITH ", "WITH RECURSIVE ", 1) + """,
cs AS (SELECT * FROM (SELECT i, j, p, row_number() OVER w AS r, count(*) OVER (PARTITION BY i) AS n, max(p) OVER (PARTITION BY i) AS best FROM scores WINDOW w AS (PARTITION BY i ORDER BY p DESC, j)) WHERE best >= 0.001),
dp AS (SELECT i, r AS k, CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS m, CAST(1 AS DOUBLE) AS q FROM cs WHERE r <= 12
  UNION ALL SELECT d.i, d.k, c.r, d.m + h AS m, sum(d.q * CASE WHEN h = 1 THEN c.p ELSE 1 - c.p END) AS q
  FROM dp d JOIN cs c ON c.i = d.i AND c.r = d.r + 1 CROSS JOIN (SELECT unnest([0, 1]) AS h) WHERE h = 1 OR c.r <> d.k GROUP BY d.i, d.k, c.r, d.m + h),
wk AS (SELECT dp.i, dp.k, dp.m, dp.q FROM dp JOIN (SELECT DISTINCT i, n FROM cs) z ON z.i = dp.i AND z.n = dp.r),
ev AS (SELECT x.i, x.r AS k, sum(1.25 * w.q / (0.25 * w.m + x.r)) AS e FROM cs x JOIN wk w ON w.i = x.i AND w.k <= x.r WHERE x.r <= 12 GROUP BY x.i, x.r
  UNION ALL SELECT i, 0, product(1 - p) FROM cs GROUP BY i),
bs AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY i ORDER BY round(e, 12) DESC, k) = 1)
SELECT ids.i, coalesce(string_agg(CAST(c.j AS VARCHAR), ',' ORDER BY c.r) FILTER (c.j IS NOT NULL), '') AS ids, round(coalesce(any_value(bs.e), 1.0), 6) AS expected
FROM ids LEFT JOIN bs USING (i) LEFT JOIN cs c ON c.i = ids.i AND c.r <= bs.k GROUP BY ids.i"""

QUERIES = {
    "token_df_idf": (lambda s, f: feat.token_idf(documents(s, f)), sql.normalized() + sql.idf() + " SELECT * FROM idf"),
    "pair_set_features": (lambda s, f: feat.plain_features(_paired(s, f)).select("i", "j", *_SETS), _plain_sql(_SETS)),
    "pair_meta_features": (lambda s, f: feat.plain_features(_paired(s, f)).select("i", "j", *_META), _plain_sql(_META)),
    "pair_legal_skeleton": (lambda s, f: feat.plain_features(_paired(s, f)).select("i", "j", "lg_both", "lg_same", "lg_conflict"), _legal_sql()),
    "pair_idf_overlap": (_idf_features, _idf_sql() + f" SELECT i, j, {', '.join(_IDF)} FROM name_f JOIN addr_f USING (i, j)"),
    "pair_idf_scaled": (_scaled, sql.blocked(CAPPED) + sql.idf() + ", top AS (SELECT country, max(idf) AS l FROM idf GROUP BY country) SELECT i, j, country, round(s_name / l, 6) AS s_name, round(s_addr / l, 6) AS s_addr, round(s_mix / l, 6) AS s_mix, round(s_all / l, 6) AS s_all FROM cand JOIN norm ON eid = i JOIN top USING (country)"),
    "pair_jaro_winkler": (lambda s, f: _paired(s, f).where("name_core <> '' and name_core_b <> ''").select("i", "j", F.round(jaro_winkler_udf("name_core", "name_core_b"), 6).alias("jw")), _PAIRED + " SELECT i, j, round(jaro_winkler_similarity(name_core, name_core_b), 6) AS jw FROM pr WHERE name_core <> '' AND name_core_b <> ''"),
    "pair_context": (_context, _CONTEXT_SQL),
    "cand_competition": (_compete, _COMPETE_SQL),
    "fuzzy_scores": (_fuzzy, None),
    "pair_features_all": (_features_all, None),
    "one_owner_hard": (lambda s, f: _rounded(dec.one_owner(scores(s, f), "hard")), SCORES + OWNED + " SELECT i, j, p FROM owned"),
    "one_owner_soft": (_soft, SCORES + " SELECT i, j, round(p / greatest(1.0, sum(p) OVER (PARTITION BY j)), 6) AS p FROM scores"),
    "decide_threshold_gate": (lambda s, f: _lists(ids(s, f), dec.decide_threshold(scores(s, f), 0.5, 0.3, 0.6)), SCORES + ", b AS (SELECT *, max(p) OVER (PARTITION BY i) AS best FROM scores), g AS (SELECT * FROM b WHERE best >= 0.5 AND p >= 0.3 AND p >= 0.6 * best)" + LISTS.format(chosen="g")),
    "country_word_rule": (_country_rule, SCORES + ", has AS (SELECT eid FROM norm WHERE list_contains(string_split(name_n, ' '), lower(country))) SELECT i, j, CASE WHEN j IN (SELECT eid FROM has) AND i NOT IN (SELECT eid FROM has) THEN 0.0 ELSE p END AS p FROM scores"),
    "blend_logit": (lambda s, f: _rounded(dec.blend(scores(s, f), _second(s, f), 0.6)), _BLEND + " SELECT i, j, round(CASE WHEN ce IS NULL THEN p ELSE m END, 6) AS p FROM mx"),
    "blend_veto": (lambda s, f: _rounded(dec.blend(scores(s, f), _second(s, f), 0.6, True)), _BLEND + " SELECT i, j, round(CASE WHEN ce IS NULL THEN p ELSE least(p, m) END, 6) AS p FROM mx"),
    "ensemble_avg": (_ensemble, SCORES + " SELECT i, j, round((p + p * 0.5 + p * p) / 3, 6) AS p FROM scores"),
    "top_one": (lambda s, f: dec.top_one(scores(s, f)), SCORES + " SELECT i, j, p FROM scores QUALIFY row_number() OVER (PARTITION BY i ORDER BY p DESC, j) = 1"),
    "split_seen_unseen": (_seen, f"{sql.normalized()} SELECT eid, CASE WHEN country IN ('de', 'en') THEN 'seen' ELSE 'unseen' END AS part FROM norm"),
    "idlist_output": (lambda s, f: _lists(ids(s, f), dec.one_owner(scores(s, f), "hard").where("p >= 0.75")), SCORES + OWNED + ", g AS (SELECT * FROM owned WHERE p >= 0.75)" + LISTS.format(chosen="g")),
    "expected_f_selection": (lambda s, f: dec.decide_expected_f(ids(s, f), scores(s, f)).select("i", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), F.round("expected", 6).alias("expected")), _EXPECTED_SQL),
}
