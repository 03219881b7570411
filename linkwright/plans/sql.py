"""The SQL that states the engine's results independently: pieces that chain into one WITH query."""

from __future__ import annotations

from ..functions import fixed
from ..functions.text import LATIN_FROM, LATIN_TO, LATIN_TWO, PHONETIC_LEGAL, PHONETIC_STOP, RULES
from ..operators.blocking import FAMILIES, Blocking
from .records import DOCUMENTS_SQL


def text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def listed(words) -> str:
    return "(" + ", ".join(map(text, words)) + ")"


def sub(x: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({x}, {text(pattern)}, {text(to)}, 'g')"


def latin(x: str) -> str:
    x = f"translate({x}, {text(LATIN_FROM)}, {text(LATIN_TO)})"
    for a, b in LATIN_TWO.items():
        x = f"replace({x}, {text(a)}, {text(b)})"
    return x


def toks(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda z: z <> '')"


def ordered_distinct(x: str) -> str:
    return f"list_filter({x}, lambda z, k: list_position({x}, z) = k)"


def canonical(x: str, table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {text(a)} THEN {text(b)}" for a, b in table.items())
    return f"trim({sub(f"array_to_string(list_transform(string_split({x}, ' '), lambda z: CASE z {cases} ELSE z END), ' ')", '[ ]+')})"


def skeleton(x: str) -> str:
    x = f"replace({x}, 'ph', 'f')"
    x = f"replace({sub(f'substr({x}, 1, 1)', 'h', '')} || {sub(f'substr({x}, 2)', '[aeiouyh]', '')}, 'x', 'ks')"
    for letters, to in fixed.SOUNDS:
        x = sub(x, f"[{letters}]", to)
    x = sub(x, "m([^aeiouym])", "n\\1")
    for c in fixed.RUNS:
        x = sub(x, f"{c}{{2,}}", c)
    return x


def skeletons(x: str) -> str:
    return f"array_to_string(list_transform({toks(x)}, lambda q: {skeleton('q')}), ' ')"


def normalized(rules: str = "n2", records: str = DOCUMENTS_SQL) -> str:
    """WITH ... norm: the normalized records."""
    v = RULES[rules]
    names, places = dict(v.names), dict(v.addresses)
    n = f"lower({latin('name_raw')})"
    n = sub(sub(sub(n, r"\(id:[^)]*\)"), r"\bm/s\b"), fixed.ALIAS, " | ")
    a = sub(f"lower({latin('addr_raw')})", fixed.NULL_WORDS)
    a = sub(sub(sub(a, r"(\d+)(?:st|nd|rd|th)\b", r"\1"), r"(\d)([a-z])", r"\1 \2"), r"([a-z])(\d)", r"\1 \2")
    a = f"trim({sub(sub(a, '&', ' and '), '[^a-z0-9]+')})"

    def core(x: str) -> str:
        kept = f"list_filter(string_split({x}, ' '), lambda z: z <> '' AND z NOT IN {listed(v.drop)})"
        return f"array_to_string({ordered_distinct(kept)}, ' ')"

    return f"""WITH {records},
n0 AS (SELECT eid, src, trim(coalesce(country, '')) AS country, coalesce(name_raw, '') AS name_raw, coalesce(addr_raw, '') AS addr_raw FROM rec),
n1 AS (SELECT *, CASE WHEN regexp_matches(name_raw, '^[\\x00-\\x7F]*$') THEN 0 WHEN regexp_matches(name_raw, '^[\\x00-\\x7FÀ-ɏ]*$') THEN 1 ELSE 2 END AS script,
  {n} AS n, {a} AS a FROM n0),
n2 AS (SELECT *, nullif(regexp_extract(trim(n), {text(fixed.WEB)}, 1), '') AS web FROM n1),
n3 AS (SELECT * EXCLUDE (n), trim({sub(sub(sub("coalesce(web, n)", "[&+]", " and "), "['.]", ""), "[^a-z0-9|]+")}, ' |') AS n FROM n2),
n4 AS (SELECT *, {canonical("replace(n, '|', ' ')", names)} AS name_n, {canonical("trim(split_part(n, '|', 2))", names)} AS alias FROM n3),
n5 AS (SELECT *, {core('name_n')} AS core, {core('alias')} AS name_alias, {canonical('a', places)} AS addr_n,
  list_transform(regexp_extract_all(a, '[0-9]+'), lambda z: coalesce(nullif(ltrim(z, '0'), ''), '0')) AS nums FROM n4),
norm AS (SELECT eid, src, country, name_raw, addr_raw, script, name_n, CASE WHEN core = '' THEN name_n ELSE core END AS name_core, name_alias,
  CASE WHEN web IS NULL THEN 0 ELSE 1 END AS name_web, addr_n, array_to_string(list_sort(list_distinct(nums)), ' ') AS addr_nums FROM n5)"""


def token_tables() -> str:
    """... tok: (eid, src, country, kind, t), distinct; pos is the token's place."""
    name, addr = toks("concat_ws(' ', name_core, name_alias)"), f"list_filter({toks('addr_n')}, lambda z: regexp_matches(z, '^[a-z][a-z0-9]{{2,}}$'))"
    sound = f"list_transform(list_filter({name}, lambda z: regexp_matches(z, '^[a-z]{{3,}}$')), lambda q: {skeleton('q')})"
    return f""",
t0 AS (SELECT eid, src, country, 'name' AS kind, unnest({name}) AS t FROM norm
  UNION ALL SELECT eid, src, country, 'addr', unnest({addr}) FROM norm
  UNION ALL SELECT eid, src, country, 'phon', unnest({sound}) FROM norm),
tok AS (SELECT DISTINCT * FROM t0 WHERE kind <> 'phon' OR (length(t) >= 3 AND t NOT IN {listed(PHONETIC_STOP)})),
freq AS (SELECT country, kind, t, count(*) AS f FROM tok GROUP BY ALL)"""


def keys(config: Blocking) -> str:
    """... keys: (eid, src, country, fam, key)."""
    c = config
    return f""",
rare AS (SELECT eid, src, country, kind, t, row_number() OVER (PARTITION BY eid, kind ORDER BY f, t) AS r FROM tok JOIN freq USING (country, kind, t)),
nm AS (SELECT * FROM rare WHERE kind = 'name' AND r <= {c.rare_name}),
ad AS (SELECT * FROM rare WHERE kind = 'addr' AND r <= {c.rare_addr}),
ph AS (SELECT * FROM rare WHERE kind = 'phon' AND r <= {c.rare_name}),
nu AS (SELECT eid, src, country, t, row_number() OVER (PARTITION BY eid ORDER BY length(t) DESC, t) AS r FROM
  (SELECT eid, src, country, unnest({toks('addr_nums')}) AS t FROM norm) QUALIFY r <= {c.numbers}),
aa0 AS (SELECT eid, src, country, list_filter({toks('addr_n')}, lambda z: regexp_matches(z, '^[a-z][a-z0-9]{{2,}}$')) AS l FROM norm),
aa AS (SELECT eid, src, country, unnest(list_slice({ordered_distinct('l')}, 1, {c.all_addr})) AS t FROM aa0),
k0 AS (
  SELECT eid, src, country, 'N1' AS fam, 'N1|' || t AS key FROM nm
  UNION SELECT eid, src, country, 'N1', 'N1|' || replace(name_core, ' ', '') FROM norm WHERE replace(name_core, ' ', '') <> ''
  UNION SELECT a.eid, a.src, a.country, 'N2', 'N2|' || a.t || '|' || b.t FROM nm a JOIN nm b ON a.eid = b.eid AND a.t < b.t
  UNION SELECT eid, src, country, 'N3', 'N3|' || substr(t, 1, 4) FROM nm WHERE length(t) >= 5
  UNION SELECT a.eid, a.src, a.country, 'A1', 'A1|' || a.t || '|' || b.t FROM nu a JOIN ad b USING (eid)
  UNION SELECT a.eid, a.src, a.country, 'A2', 'A2|' || a.t || '|' || b.t FROM ad a JOIN ad b ON a.eid = b.eid AND a.t < b.t
  UNION SELECT a.eid, a.src, a.country, 'M1', 'M1|' || a.t || '|' || b.t FROM nm a JOIN ad b USING (eid) WHERE a.r <= 3 AND b.r <= 2
  UNION SELECT eid, src, country, 'P1', 'P1|' || t FROM ph
  UNION SELECT a.eid, a.src, a.country, 'P2', 'P2|' || a.t || '|' || b.t FROM ph a JOIN ph b ON a.eid = b.eid AND a.t < b.t
  UNION SELECT a.eid, a.src, a.country, 'A3', 'A3|' || a.t || '|' || b.t FROM nu a JOIN nu b ON a.eid = b.eid AND a.t < b.t
  UNION SELECT a.eid, a.src, a.country, 'A4', 'A4|' || a.t || '|' || b.t FROM nu a JOIN aa b USING (eid) WHERE a.r <= {c.house_numbers}
  UNION SELECT a.eid, a.src, a.country, 'PN', 'PN|' || a.t || '|' || b.t FROM ph a JOIN nu b USING (eid) WHERE b.r <= {c.house_numbers}),
keys AS (SELECT DISTINCT * FROM k0)"""


def postings(config: Blocking) -> str:
    cap = "CASE fam " + " ".join(f"WHEN '{f}' THEN {config.cap if config.cap is not None else n}" for f, (_, n) in FAMILIES.items()) + " END"
    return f""",
total AS (SELECT country, count(*) AS n FROM norm WHERE src IN (2, 3) GROUP BY country),
dfs AS (SELECT country, fam, key, count(*) AS df FROM keys WHERE src IN (2, 3) GROUP BY ALL HAVING count(*) <= {cap}),
post AS (SELECT k.country, k.fam, k.key, k.eid AS j, round(ln(n) - ln(df), 9) AS w FROM keys k JOIN dfs USING (country, fam, key) JOIN total USING (country) WHERE k.src IN (2, 3))"""


def hits(config: Blocking) -> str:
    salt = "CASE fam " + " ".join(f"WHEN '{f}' THEN {k}" for k, f in enumerate(FAMILIES, 1)) + " END"
    return f""",
h0 AS (SELECT k.eid AS i, p.j, k.fam, round(sum(p.w), 6) AS w FROM keys k JOIN post p USING (country, fam, key) WHERE k.src = 1 GROUP BY ALL),
hits AS (SELECT *, row_number() OVER (PARTITION BY i, fam ORDER BY w DESC, md5(concat_ws('|', i, j, {salt})), j) AS r FROM h0 QUALIFY r <= {config.top})"""


def merged(config: Blocking) -> str:
    """... cand: the candidate pairs."""
    group = "CASE " + " ".join(f"WHEN fam IN {listed([f for f, (g, _) in FAMILIES.items() if g == x])} THEN '{x}'" for x in ("name", "addr", "mix")) + " END"
    rank = ", ".join(f"row_number() OVER (PARTITION BY i ORDER BY s_{g} DESC, md5(concat_ws('|', i, j, 0)), j) AS r_{g}" for g in ("all", "name", "addr"))
    return f""",
s0 AS (SELECT i, j, {", ".join(f"round(coalesce(sum(w) FILTER ({group} = '{g}'), 0), 6) AS s_{g}" for g in ("name", "addr", "mix"))}, count(*) AS n_fam FROM hits GROUP BY ALL),
s1 AS (SELECT *, round(s_name + s_addr + s_mix, 6) AS s_all FROM s0),
s2 AS (SELECT *, {rank} FROM s1),
cand AS (SELECT * FROM s2 WHERE r_all <= {config.total} OR (r_name <= {config.side} AND s_name > 0) OR (r_addr <= {config.side} AND s_addr > 0))"""


def blocked(config: Blocking, records: str = DOCUMENTS_SQL) -> str:
    return normalized("n2", records) + token_tables() + keys(config) + postings(config) + hits(config) + merged(config)


def idf() -> str:
    """... idf: (country, kind, t, idf) over name_core and addr_n tokens of all sources."""
    return f""",
i0 AS (SELECT country, 'name' AS kind, unnest(list_distinct({toks('name_core')})) AS t FROM norm
  UNION ALL SELECT country, 'addr', unnest(list_distinct({toks('addr_n')})) FROM norm),
ncountry AS (SELECT country, count(*) AS n FROM norm GROUP BY country),
idf AS (SELECT country, kind, t, round(ln(CAST(n AS DOUBLE) / count(*)), 6) AS idf FROM i0 JOIN ncountry USING (country) GROUP BY country, kind, t, n)"""


def legal(name: str, script: str) -> str:
    plain = f"list_transform(list_filter({toks(name)}, lambda z: z IN {listed(fixed.LEGAL_WORDS)}), lambda q: {skeleton('q')})"
    sound = f"list_filter(list_transform({toks(name)}, lambda q: {skeleton('q')}), lambda z: z IN {listed(PHONETIC_LEGAL)})"
    return f"array_to_string(list_sort(list_distinct(CASE WHEN {script} = 2 THEN {sound} ELSE {plain} END)), ' ')"
