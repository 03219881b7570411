"""A whole run over generated sources, and the stream."""

import random

import pytest
from pyspark.sql import functions as F

from linkwright.__main__ import main
from linkwright.operators.blocking import Blocking
from linkwright.operators.normalize import normalize
from linkwright.plans import linkage
from linkwright.plans.records import from_documents
from linkwright.sources import files
from linkwright.streaming.incremental import asking_keys, link_batch, link_stream

WORDS = "alpha bravo carbon delta ember falcon granite harbor indigo jasper kestrel lumen meadow nickel onyx prairie quartz raven saffron timber".split()


def noisy(r, name, street):
    if r.random() < 0.4:
        street = street.replace("Road", "Rd")
    if r.random() < 0.3:
        k = r.randrange(1, len(name) - 2)
        name = name[:k] + name[k + 1] + name[k] + name[k + 2 :]
    return name, street


def make_split(root, split, n=120, seed=0):
    r = random.Random(seed)
    rows, truth, serial = {1: [], 2: [], 3: []}, [], 0
    for i in range(n):
        name = f"{r.choice(WORDS).title()} {r.choice(WORDS).title()} {r.choice(WORDS).title()} Ltd"
        street = f"{r.randrange(1, 999)} {r.choice(WORDS).title()} Road, {r.choice(WORDS).title()} {r.randrange(10000, 99999)}"
        country = r.choice(("US", "IN"))
        rows[1].append((f"S1-{i}", name, street, country))
        found = []
        for _ in range(r.choice((0, 1, 1, 2, 3))):
            k, serial = r.choice((2, 3)), serial + 1
            rows[k].append((f"S{k}-{serial}", *noisy(r, name, street), country))
            found.append(f"S{k}-{serial}")
        truth.append((f"S1-{i}", ",".join(found)))
    folder = root / split
    folder.mkdir()
    for k, part in rows.items():
        (folder / f"{split}_source{k}.tsv").write_text("\n".join(["\t".join(files.SOURCE), *("\t".join(x) for x in part)]) + "\n")
    (folder / f"{split}_ground_truth.tsv").write_text("\n".join(["source1_entity_id\tmatched_entity_ids", *("\t".join(x) for x in truth)]) + "\n")


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    make_split(root, "train", seed=1)
    make_split(root, "test", seed=2)
    return linkage.Run(f"file://{root}", f"file://{root}/out", folds=2)


def test_whole_run(spark, run, capsys):
    oof = linkage.train(spark, run, "train", rounds=3, depth=3)
    total = linkage.report(spark, run, "train", oof).where("country = 'ALL'").first()
    assert total.n == 120 and total.macro_f05 > 0.85
    assert len(linkage.inputs(linkage.features(spark, run, "train", True))) >= 70
    findings = {r.finding: r.n for r in linkage.submit(spark, run, "test").collect()}
    assert set(findings.values()) == {0} and "unknown_id" in findings
    test = linkage.report(spark, run, "test", linkage.predict(spark, run, "test")).where("country = 'ALL'").first()
    assert test.macro_f05 > 0.8
    main(["block", "--root", run.root, "--out", run.out, "--split", "test"])
    assert capsys.readouterr().out.startswith("block: ")


def test_stream(spark, sf, tmp_path):
    records = from_documents(spark, sf)
    config = Blocking(cap=50)
    asking = asking_keys(normalize(records), config).cache()
    new = records.where("src > 1")
    new.repartition(2).write.parquet(f"file://{tmp_path}/in")
    query = link_stream(spark.readStream.schema(new.schema).parquet(f"file://{tmp_path}/in"), asking, f"file://{tmp_path}/links", f"file://{tmp_path}/state", config)
    query.awaitTermination(120)
    assert query.exception() is None
    got = spark.read.parquet(f"file://{tmp_path}/links")
    want = link_batch(new, asking, config)
    assert sorted((r.j, r.i, r.score) for r in got.select("j", "i", "score").collect()) == sorted((r.j, r.i, r.score) for r in want.collect())
    assert got.groupBy("j").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] <= 5
