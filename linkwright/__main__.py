"""python -m linkwright STAGE --root DIR --out DIR [--split NAME]: one stage of a linkage run."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import linkage
from .sources.files import markdown

STAGES = ("prepare", "block", "features", "train", "predict", "submit", "evaluate")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="linkwright", description=__doc__)
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--root", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--split", default="train")
    p.add_argument("--rules", default="n2", choices=("n1", "n2"))
    p.add_argument("--owner", default="hard", choices=("none", "hard", "soft"))
    p.add_argument("--tau", type=float, default=0.75)
    p.add_argument("--folds", type=int, default=5)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("linkwright").getOrCreate()
    run = linkage.Run(a.root, a.out, a.rules, owner=a.owner, tau=a.tau, folds=a.folds)
    if a.stage == "evaluate":
        out = linkage.report(spark, run, a.split, linkage.train(spark, run, a.split))
    elif a.stage == "submit":
        out = linkage.submit(spark, run, a.split)
    else:
        made = {"prepare": linkage.records, "block": linkage.blocked, "train": linkage.train, "predict": linkage.predict, "features": lambda s, r, x: linkage.features(s, r, x, False)}[a.stage](spark, run, a.split)
        print(f"{a.stage}: {made.count()} rows")
        return
    print(markdown([r.asDict() for r in out.orderBy(out.columns[0]).collect()]))


if __name__ == "__main__":
    main()
