"""Files: sources, id lists, stores and checks of them."""

import pytest
from pyspark.sql import functions as F

from linkwright.operators import normalize as norm
from linkwright.operators import validate as val
from linkwright.plans.records import from_documents
from linkwright.sources import files


def write(path, text):
    path.write_text(text)
    return f"file://{path}"


def test_read_source(spark, tmp_path):
    good = write(tmp_path / "a.tsv", 'entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-5\t "Quoted, Inc" \t1 Main St\tUS \nS2-6\t\tNULL\tUS\n')
    rows = files.read_source(spark, good).collect()
    assert [tuple(r) for r in rows] == [("S1-5", '"Quoted, Inc"', "1 Main St", "US", "S1"), ("S2-6", "", "NULL", "US", "S2")]
    assert [r.eid for r in files.as_records(files.read_source(spark, good)).collect()] == [10**12 + 5, 2 * 10**12 + 6]
    bad = write(tmp_path / "b.tsv", "entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-5\tx\n")
    with pytest.raises(Exception):
        files.read_source(spark, bad).collect()
    wrong = write(tmp_path / "c.tsv", "entity_id\tbusiness_name\tbusiness_address\tcountry\nQ1-5\tx\ty\tz\n")
    with pytest.raises(Exception, match="bad entity id"):
        files.as_records(files.read_source(spark, wrong)).collect()


def test_split_of_three_sources(spark, tmp_path):
    (tmp_path / "dev").mkdir()
    for k in (1, 2, 3):
        write(tmp_path / "dev" / f"dev_source{k}.tsv", f"entity_id\tbusiness_name\tbusiness_address\tcountry\nS{k}-1\tn{k}\ta\tUS\n")
    assert sorted((r.src, r.name_raw) for r in files.read_split(spark, f"file://{tmp_path}", "dev").collect()) == [(1, "n1"), (2, "n2"), (3, "n3")]


def test_id_lists_round_trip(spark, tmp_path):
    ids = spark.createDataFrame([(0, "S1-1"), (1, "S1-2"), (2, "S1-1")], "pos long, id string")
    lists = spark.createDataFrame([("S1-1", ["S2-1", "S2-1", "S1-9", "S3-2"])], "id string, ids array<string>")
    out = f"file://{tmp_path}/m"
    files.write_id_lists(ids, lists, out)
    (part,) = (tmp_path / "m").glob("part-*")
    assert part.read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-2\nS1-2\t\n"
    back = files.read_id_lists(spark, out)
    assert {r.id: list(r.ids) for r in back.collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": []}
    assert sorted(tuple(r) for r in files.id_pairs(back).collect()) == [(10**12 + 1, 2 * 10**12 + 1, 2), (10**12 + 1, 3 * 10**12 + 2, 3)]


def test_decisions_and_checks(spark, tmp_path):
    ids = spark.createDataFrame([(0, 10**12 + 1), (1, 10**12 + 2)], "pos long, i long")
    scores = spark.createDataFrame([(10**12 + 1, 2 * 10**12 + 5, 0.4), (10**12 + 1, 3 * 10**12 + 6, 0.9)], "i long, j long, p double")
    files.write_decisions(ids, scores, scores.where("p > 0.5"), f"file://{tmp_path}/run")
    cand = files.read_id_lists(spark, f"file://{tmp_path}/run/candidates", "candidate_entity_ids")
    match = files.read_id_lists(spark, f"file://{tmp_path}/run/matches")
    assert list(cand.where("id = 'S1-1'").first().ids) == ["S3-6", "S2-5"] and list(match.where("id = 'S1-1'").first().ids) == ["S3-6"]
    text = [d.select("id", F.array_join("ids", ",").alias("ids")) for d in (match, cand)]
    assert val.not_candidates(*text).count() == 0 and val.not_candidates(text[1], text[0]).count() == 1
    order = match.select("id").withColumn("pos", F.when(F.col("id") == "S1-1", 0).otherwise(1))
    wanted = spark.createDataFrame([(0, "S1-2"), (1, "S1-1")], "pos int, id string")
    assert val.same_order(order, wanted).count() == 2


def test_store_and_stage(spark, sf, tmp_path):
    path = f"file://{tmp_path}/store"
    records = norm.normalize(from_documents(spark, sf))
    files.write_store(records, path)
    one = files.read_store(spark, path, [1], ["eid", "name_core"])
    assert one.count() == records.where("src = 1").count()
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    assert files.stage(spark, f"file://{tmp_path}/s", make).count() == files.stage(spark, f"file://{tmp_path}/s", make).count() == 3
    assert made == [1]
    pairs = spark.createDataFrame([(records.first().eid, records.first().eid)], "i long, j long")
    assert " ; " in files.pair_texts(pairs, records).first().text_a
    assert files.markdown([{"a": 1, "b": 2}]) == "| a | b |\n| --- | --- |\n| 1 | 2 |" and files.markdown([]) == "" and '"a": 1' in files.as_json([{"a": 1}])
