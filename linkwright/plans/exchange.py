"""Queries of sources and sinks: what is written to the shared folder and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode_id, encode_id
from ..operators import decide as dec
from ..operators import splits as sp
from ..operators import validate as val
from ..operators.normalize import normalize_frame
from ..sources import files
from . import sql
from .blocking import CAPPED, folded, documents, views_sql
from .evaluation import _DEC, LABELLED, STRATA, _md5
from .pairs import OWNED, SCORES, _cand, ids, scores, truth
from .records import DOCUMENTS_SQL, PARTS_SQL, from_documents, from_parts


def shared(spark: SparkSession) -> str:
    """A new folder that driver and executors share; below a temporary one only where all are one machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = f"file://{tempfile.gettempdir()}"
    return f"{root.rstrip('/')}/linkwright-{uuid.uuid4().hex[:12]}"


def _sources(s, f):
    at = shared(s)
    for k in (1, 2, 3):
        files.write_source(from_documents(s, f).where(F.col("src") == k), files.source_path(at, "x", k))
    return files.read_split(s, at, "x")


def _store(s, f):
    at = shared(s)
    files.write_store(documents(s, f), at)
    return files.read_store(s, at, [2, 3], ["eid", "src", "name_core"])


def _stage(s, f):
    """A stage that is asked for again with another maker gives what it wrote first."""
    at = shared(s)
    files.stage(s, at, lambda: _cand(s, f).select("i", "j", "n_fam"))
    return files.stage(s, at, lambda: s.createDataFrame([], "i long, j long, n_fam int"))


def _order(s, f):
    """Source 1 as a file: ids in the order of their numbers' last digits, with their places."""
    d = ids(s, f).select("i").withColumn("k", F.col("i") % 10)
    return d.join(d.groupBy("k").agg(F.count("*").alias("c")), "k").select((F.col("k") * 10**12 + F.col("i") % 10**12).alias("pos"), "i")


def _lists(s, f, which):
    at, x = shared(s), scores(s, f).select("i", "j", "p")
    files.write_decisions(_order(s, f), x, dec.one_owner(x, "hard").where("p >= 0.75"), at)
    name, column = which
    return files.read_id_lists(s, f"{at}/{name}", column)


_CANDIDATES, _MATCHES = ("candidates", "candidate_entity_ids"), ("matches", "matched_entity_ids")


def _pairs_back(s, f):
    return files.id_pairs(_lists(s, f, _MATCHES))


def _strays(s, f):
    """Candidates that are no matches, by the check that matches are candidates, asked the wrong way round."""
    both = [_lists(s, f, w).select("id", F.array_join("ids", ",").alias("ids")) for w in (_CANDIDATES, _MATCHES)]
    return val.not_candidates(*both).select("id", F.size("strays").cast("long").alias("strays"))


def _misplaced(s, f):
    """Places of ids in the order of their text against that of their numbers."""
    d = ids(s, f).select(decode_id(F.col("i")).alias("id"), "i")
    by = [d.select("id", F.row_number().over(sp.Window.orderBy(c)).alias("pos")) for c in ("id", "i")]
    return val.same_order(*by)


def _text_ids(s, f):
    at = shared(s)
    files.write_ids(sp.lockbox(sp.buckets(ids(s, f), truth(s, f)), ids(s, f).where(sp.in_sample(5, 7)), 0.3, 2026), at)
    return s.read.text(at).select(F.col("value").alias("id"), encode_id(F.col("value")).alias("i"))


def _table_back(s, f):
    at = shared(s)
    stats = scores(s, f).groupBy("country").agg(F.count("*").alias("pairs"), F.round(F.avg("p"), 6).alias("mean_p"))
    files.write_table(stats, at)
    return s.read.schema("country string, pairs long, mean_p double").option("header", True).csv(at)


def _meta_back(s, f):
    at = shared(s)
    files.write_meta(s, {"tau": 0.75, "owner": "hard", "pairs": scores(s, f).count()}, at)
    return s.read.schema("tau double, owner string, pairs long").json(at)


def _export(s, f):
    t = truth(s, f).select("i", "j", F.lit(1).alias("y"))
    pairs = scores(s, f).select("i", "j", "p").join(t, ["i", "j"], "left").na.fill(0, ["y"])
    return files.pair_export(pairs, from_documents(s, f), 0.2, 0.9)


def _hardest(s, f):
    """The 15 true pairs with the lowest scores of each country."""
    d = scores(s, f).join(truth(s, f).select("i", "j"), ["i", "j"])
    return d.withColumn("r", F.row_number().over(sp.Window.partitionBy("country").orderBy("p", "i", "j"))).where("r <= 15").select("country", "i", "j", "p")


def _medians(s, f):
    return documents(s, f).groupBy("country", "src").agg(F.median(F.length("name_core")).alias("name_length"), F.median(F.length("addr_n")).alias("addr_length"))


def _diagonal(s, f):
    """Tables with different columns one below the other, what a table lacks null."""
    a = documents(s, f).groupBy("src").agg(F.count("*").alias("n"))
    b = truth(s, f).groupBy("src").agg(F.count("*").alias("matches"))
    return a.unionByName(b, allowMissingColumns=True).select("src", "n", "matches")


def _overlaps(s, f):
    """Records that two samples which must have none in common share, and the sizes of both."""
    strata = sp.buckets(ids(s, f), truth(s, f))
    dev = ids(s, f).where(sp.in_sample(5, 7))
    parts = {"lockbox": sp.lockbox(strata, dev, 0.3, 2026).select("i"), "dev": dev.select("i")}
    found = {**parts, "both": parts["lockbox"].join(parts["dev"], "i", "left_semi")}
    out = [d.agg(F.count("*").alias("n")).select(F.lit(k).alias("part"), "n") for k, d in found.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


_FRAME = ["name_norm", "name_core", "name_legal", "name_sorted", "name_acronym", "name_compact", "addr_norm", "addr_sorted", "addr_digits", "addr_postal", "addr_first_num", "addr_landmark", "addr_ntok"]
_IDS = "string_agg({0}, ',' ORDER BY p DESC, j) FILTER (j IS NOT NULL)"
_LI = f"SELECT {_DEC.format('ids.i')} AS id, coalesce({_IDS.format(_DEC.format('j'))}, '') AS ids FROM ids LEFT JOIN {{0}} USING (i) GROUP BY ids.i"
_G = ", g AS (SELECT i, j, src, p FROM owned WHERE p >= 0.75)"
_BOX = f", box AS (SELECT i FROM (SELECT i, row_number() OVER (PARTITION BY country, bucket ORDER BY {_md5(2026)}, i) - 1 AS pos, count(*) OVER (PARTITION BY country, bucket) AS size FROM strata WHERE NOT ({_md5(5)} < '{16**12 // 7:012x}')) WHERE pos < round(size * 0.3)), dev AS (SELECT i FROM ids WHERE {_md5(5)} < '{16**12 // 7:012x}')"


def _joined(column: str) -> str:
    return f"trim(regexp_replace({sql.latin(f'{column}.name_raw')} || ' ; ' || {sql.latin(f'{column}.addr_raw')}, '\\s+', ' ', 'g'))"


QUERIES = {
    "source_round_trip": (_sources, f"WITH {DOCUMENTS_SQL} SELECT eid, src, trim(coalesce(country, '')) AS country, trim(coalesce(name_raw, '')) AS name_raw, trim(coalesce(addr_raw, '')) AS addr_raw FROM rec"),
    "store_projection": (_store, sql.normalized() + " SELECT eid, src, name_core FROM norm WHERE src IN (2, 3)"),
    "stage_resume": (_stage, sql.blocked(CAPPED) + " SELECT i, j, n_fam FROM cand"),
    "candidate_file": (lambda s, f: _lists(s, f, _CANDIDATES).select("id", F.array_join("ids", ",").alias("ids")), SCORES + " " + _LI.format("scores")),
    "match_file": (lambda s, f: _lists(s, f, _MATCHES).select("id", F.array_join("ids", ",").alias("ids")), SCORES + OWNED + _G + " " + _LI.format("g")),
    "match_file_pairs": (_pairs_back, SCORES + OWNED + _G + " SELECT i, j, CAST(src AS INTEGER) AS src FROM g"),
    "check_strays": (_strays, SCORES + OWNED + _G + f", n AS (SELECT s.i, count(*) AS strays FROM scores s LEFT JOIN g ON g.i = s.i AND g.j = s.j WHERE g.j IS NULL GROUP BY s.i) SELECT {_DEC.format('i')} AS id, strays FROM n"),
    "check_order": (_misplaced, f"{sql.normalized()}, d AS (SELECT {_DEC.format('eid')} AS id, eid AS i FROM norm WHERE src = 1), a AS (SELECT id, CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS pos FROM d), b AS (SELECT id AS wanted, CAST(row_number() OVER (ORDER BY i) AS INTEGER) AS pos FROM d) SELECT pos, id, wanted FROM a FULL JOIN b USING (pos) WHERE id IS DISTINCT FROM wanted"),
    "text_id_file": (_text_ids, STRATA + _BOX + f" SELECT {_DEC.format('i')} AS id, i FROM box"),
    "stats_file": (_table_back, SCORES + " SELECT country, count(*) AS pairs, round(avg(p), 6) AS mean_p FROM scores GROUP BY country"),
    "meta_file": (_meta_back, SCORES + " SELECT 0.75 AS tau, 'hard' AS owner, count(*) AS pairs FROM scores"),
    "pair_export": (_export, LABELLED + f" SELECT i, j, p, y, {_joined('a')} AS text_a, {_joined('b')} AS text_b FROM lab JOIN rec a ON a.eid = i JOIN rec b ON b.eid = j WHERE p BETWEEN 0.2 AND 0.9"),
    "views_frame": (lambda s, f: normalize_frame(from_parts(s, f)).select("eid", *_FRAME, "country_norm"), views_sql("eid, " + ", ".join(_FRAME) + f", {folded('country')} AS country_norm", PARTS_SQL).replace("FROM views", "FROM views JOIN rec USING (eid)")),
    "hardest_15": (_hardest, SCORES + " SELECT country, i, j, p FROM (SELECT s.country, s.i, s.j, s.p, row_number() OVER (PARTITION BY s.country ORDER BY s.p, s.i, s.j) AS r FROM scores s JOIN truth t ON t.i = s.i AND t.j = s.j) WHERE r <= 15"),
    "length_medians": (_medians, sql.normalized() + " SELECT country, src, median(length(name_core)) AS name_length, median(length(addr_n)) AS addr_length FROM norm GROUP BY ALL"),
    "diagonal_union": (_diagonal, SCORES + " SELECT src, count(*) AS n, NULL AS matches FROM norm GROUP BY src UNION ALL SELECT src, NULL, count(*) FROM truth GROUP BY src"),
    "sample_overlap": (_overlaps, STRATA + _BOX + " SELECT 'lockbox' AS part, count(*) AS n FROM box UNION ALL SELECT 'dev', count(*) FROM dev UNION ALL SELECT 'both', count(*) FROM box JOIN dev USING (i)"),
}
