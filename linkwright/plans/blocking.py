"""Queries of normalization and blocking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import decode_id, encode_id, skeleton, stable_rank, tokens
from ..operators import blocking as ops
from ..operators.normalize import address_views, name_views, normalize
from . import sql
from .records import DOCUMENTS_SQL, PARTS_SQL, from_documents, from_parts

#: A cap that prunes keys on small tables too; the queries named *_reference have the reference's caps.
CAPPED = ops.Blocking(cap=40)
PLAIN = ops.Blocking()


def documents(spark, sf, rules="n2"):
    return normalize(from_documents(spark, sf), rules)


def parts(spark, sf, rules="n2"):
    return normalize(from_parts(spark, sf), rules)


def _norm_sql(columns, rules="n2", records=DOCUMENTS_SQL):
    return f"{sql.normalized(rules, records)} SELECT {columns} FROM norm"


def folded(x: str) -> str:
    x = f"replace(replace(lower({sql.latin(x)}), '&', ' and '), '''', '')"
    return f"trim({sql.sub(sql.sub(x, '[^\\p{L}\\p{M}\\p{N}_ \\t\\n\\f\\r]'), '[ \\t\\n\\f\\r]+')})"


def views_sql(columns: str, records=DOCUMENTS_SQL) -> str:
    fold = folded
    base = fold("name_raw")
    for pattern, to in fixed.VIEW_PHRASES:
        base = sql.sub(base, pattern, to)
    forms = sql.listed(sorted(set(fixed.VIEW_LEGAL.values())))
    return f"""WITH {records},
v0 AS (SELECT eid, {sql.canonical(base, fixed.VIEW_LEGAL)} AS nb, {fold('addr_raw')} AS ab FROM rec),
v1 AS (SELECT *, {sql.toks('nb')} AS t, {sql.toks(sql.canonical('ab', fixed.VIEW_ADDRESS))} AS tk, regexp_extract_all(ab, '[0-9]+') AS dg FROM v0),
v2 AS (SELECT *, list_filter(t, lambda z: z NOT IN {forms}) AS r FROM v1),
v3 AS (SELECT *, CASE WHEN len(r) > 0 THEN r ELSE t END AS c FROM v2),
v4 AS (SELECT *, list_filter(c, lambda z: z NOT IN {sql.listed(fixed.VIEW_STOP)}) AS q FROM v3),
v5 AS (SELECT *, CASE WHEN len(q) > 0 THEN q ELSE c END AS p, list_filter(dg, lambda z: length(z) BETWEEN 4 AND 6) AS po FROM v4),
views AS (SELECT eid, array_to_string(t, ' ') AS name_norm, array_to_string(c, ' ') AS name_core,
  array_to_string(list_sort(list_distinct(list_filter(t, lambda z: z IN {forms}))), ' ') AS name_legal,
  array_to_string(list_sort(list_distinct(p)), ' ') AS name_sorted, array_to_string(list_transform(p, lambda z: substr(z, 1, 1)), '') AS name_acronym,
  array_to_string(c, '') AS name_compact, array_to_string(tk, ' ') AS addr_norm, array_to_string(list_sort(list_distinct(tk)), ' ') AS addr_sorted,
  array_to_string(dg, ' ') AS addr_digits, coalesce(po[len(po)], '') AS addr_postal, coalesce(dg[1], '') AS addr_first_num,
  CASE WHEN len(list_filter(tk, lambda z: z IN {sql.listed(fixed.LANDMARKS)})) > 0 THEN 1 ELSE 0 END AS addr_landmark, CAST(len(tk) AS INTEGER) AS addr_ntok FROM v5)
SELECT {columns} FROM views"""


_NAMES = ["name_norm", "name_core", "name_legal", "name_sorted", "name_acronym", "name_compact"]
_ADDR = ["addr_norm", "addr_sorted", "addr_digits", "addr_postal", "addr_first_num", "addr_landmark", "addr_ntok"]


def _keys(spark, sf, fam):
    source = parts if fam in ("A1", "A3", "A4", "PN") else documents
    return ops.record_keys(source(spark, sf), PLAIN).where(F.col("fam") == fam).select("eid", "country", "key")


def _keys_sql(fam):
    records = PARTS_SQL if fam in ("A1", "A3", "A4", "PN") else DOCUMENTS_SQL
    return f"{sql.normalized('n2', records)}{sql.token_tables()}{sql.keys(PLAIN)} SELECT eid, country, key FROM keys WHERE fam = '{fam}'"


def _chain(config, records=DOCUMENTS_SQL):
    return sql.normalized("n2", records) + sql.token_tables() + sql.keys(config) + sql.postings(config)


def _skeletons(spark, sf):
    words = documents(spark, sf).select(F.explode(tokens(F.col("name_n"))).alias("word")).distinct()
    return words.select("word", skeleton(F.col("word")).alias("skeleton"))


def _ids(spark, sf):
    d = from_documents(spark, sf).select("eid")
    d = d.withColumn("id", decode_id(F.col("eid")))
    return d.select("eid", "id", encode_id(F.col("id")).alias("back"), stable_rank(F.col("eid"), 7).alias("rank"))


def _candidates(spark, sf, config, source=documents):
    c = ops.candidates(source(spark, sf), config)
    return c.select("i", "j", "s_name", "s_addr", "s_mix", "s_all", "n_fam", "r_all", "r_name", "r_addr")


_CAND = "i, j, s_name, s_addr, s_mix, s_all, n_fam, r_all, r_name, r_addr"

QUERIES = {
    "norm_name_core": (lambda s, f: documents(s, f).select("eid", "name_n", "name_core"), _norm_sql("eid, name_n, name_core")),
    "norm_name_core_n1": (lambda s, f: documents(s, f, "n1").select("eid", "name_n", "name_core", "addr_n"), _norm_sql("eid, name_n, name_core, addr_n", "n1")),
    "norm_addr_nums": (lambda s, f: parts(s, f).select("eid", "addr_n", "addr_nums"), _norm_sql("eid, addr_n, addr_nums", "n2", PARTS_SQL)),
    "norm_script_class": (lambda s, f: documents(s, f).groupBy("country", "script").agg(F.count("*").alias("n")), f"{sql.normalized()} SELECT country, script, count(*) AS n FROM norm GROUP BY ALL"),
    "norm_alias_web": (lambda s, f: parts(s, f).select("eid", "name_alias", "name_web", "name_core"), _norm_sql("eid, name_alias, name_web, name_core", "n2", PARTS_SQL)),
    "views_name": (lambda s, f: name_views(from_parts(s, f)).select("eid", *_NAMES), views_sql("eid, " + ", ".join(_NAMES), PARTS_SQL)),
    "views_addr": (lambda s, f: address_views(from_parts(s, f)).select("eid", *_ADDR), views_sql("eid, " + ", ".join(_ADDR), PARTS_SQL)),
    "id_roundtrip": (_ids, f"WITH {DOCUMENTS_SQL} SELECT eid, 'S' || eid // 1000000000000 || '-' || eid % 1000000000000 AS id, eid AS back, substr(md5('7:' || eid), 1, 12) AS rank FROM rec"),
    "phonetic_skeleton": (_skeletons, f"{sql.normalized()}, w AS (SELECT DISTINCT unnest({sql.toks('name_n')}) AS word FROM norm) SELECT word, {sql.skeleton('word')} AS skeleton FROM w"),
    "token_frequency": (lambda s, f: ops.token_frequency(documents(s, f)), f"{sql.normalized()}{sql.token_tables()} SELECT * FROM freq"),
    **{f"key_family_{fam.lower()}": (lambda s, f, fam=fam: _keys(s, f, fam), _keys_sql(fam)) for fam in ops.FAMILIES},
    "block_postings_capped": (lambda s, f: ops.postings(ops.record_keys(documents(s, f), CAPPED), documents(s, f), CAPPED), _chain(CAPPED) + " SELECT country, fam, key, j, w FROM post"),
    "block_topm_family": (lambda s, f: ops.family_hits(ops.record_keys(documents(s, f), CAPPED), documents(s, f), CAPPED), _chain(CAPPED) + sql.hits(CAPPED) + " SELECT i, j, fam, w, r FROM hits"),
    "block_candidates": (lambda s, f: _candidates(s, f, CAPPED), sql.blocked(CAPPED) + f" SELECT {_CAND} FROM cand"),
    "block_candidates_numbers": (lambda s, f: _candidates(s, f, CAPPED, parts), sql.blocked(CAPPED, PARTS_SQL) + f" SELECT {_CAND} FROM cand"),
    # With the reference's own caps by family.
    "block_postings_reference": (lambda s, f: ops.postings(ops.record_keys(documents(s, f), PLAIN), documents(s, f), PLAIN), _chain(PLAIN) + " SELECT country, fam, key, j, w FROM post"),
    "block_topm_reference": (lambda s, f: ops.family_hits(ops.record_keys(documents(s, f), PLAIN), documents(s, f), PLAIN), _chain(PLAIN) + sql.hits(PLAIN) + " SELECT i, j, fam, w, r FROM hits"),
    "block_candidates_reference": (lambda s, f: _candidates(s, f, PLAIN), sql.blocked(PLAIN) + f" SELECT {_CAND} FROM cand"),
    "block_candidates_numbers_reference": (lambda s, f: _candidates(s, f, PLAIN, parts), sql.blocked(PLAIN, PARTS_SQL) + f" SELECT {_CAND} FROM cand"),
}
