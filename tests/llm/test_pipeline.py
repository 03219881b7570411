"""The pipeline's stages against the operators' plain versions, and the registered queries."""

import brute

import __spark_entry__ as entry
import corpus_pipeline as pipe
from linkwright.llm.common import table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents").cache()
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    items = [tuple(r) for r in table(spark, sf, "benchmark").collect()]
    names = [name for name, _ in pipe.STAGES]
    assert len(names) == 5
    for name, stage in pipe.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, sf).cache()
        assert out.columns == columns
        after = {r.doc_id: r.text for r in out.collect()}
        rows = list(before.items())
        if stage is pipe.quality:
            assert not [d for d in after if labels.get(d) == 0] and not [d for d in before.keys() - after.keys() if labels.get(d) == 1]
        elif stage is pipe.lines:
            want = brute.op9(rows)
            assert after == {d: t for d, t in want.items() if t == before[d] or t.strip()}
            assert all(r.n_chars == len(r.text) for r in out.collect() if r.text != before[r.doc_id])
        elif stage is pipe.near_duplicates:
            assert set(after) == {d for d, (_, c) in brute.op1(rows).items() if c == d}
        else:
            assert set(after) == {d for d, r in brute.op7(rows, items).items() if not r[4]}
        docs = out
    last = pipe.mixture(spark, docs, sf).collect()
    assert {r.doc_id for r in last} == set(after)


def test_run_and_entries(spark, sf):
    rows = pipe.run(spark, sf).collect()
    assert rows and {"doc_id", "n_tokens", "rate", "tokens"} <= set(rows[0].asDict())
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_empty_documents(spark, sf):
    docs = table(spark, sf, "documents").limit(0)
    for _, stage in pipe.STAGES:
        assert stage(spark, docs, sf).collect() == []


EDGE = [
    (1, "the first line of a text\nand a second one that others have", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (None, "the first line of a text", "en", "b"),
    (4, "and a second one that others have", "en", "b"), (5, "a text with words of its own " * 3000, "en", "b"), (5, "another text of the same document", "en", "b"), (6, "another text of the same document", "en", "a"),
    (7, " \n\t\n ", "de", "a"), (1, "the first line of a text\nand a second one that others have", "en", "a"),
]


def test_stages_on_edge_cases(spark, sf):
    """Nulls, blank and long texts, repeated rows and ids, and columns with the operators' own names."""
    names = "n_lines n_dropped task grp id comp keys row kept host path y e n s x text_ gone".split()
    d = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string").selectExpr("*", "length(text) as n_chars", *(f"'{c}!' as {c}" for c in names))
    want = {pipe.lines: [None, 1, 1, 2, 3, 5, 5, 7], pipe.near_duplicates: [None, 1, 1, 2, 3, 4, 5, 5, 7], pipe.benchmark: [None, 1, 1, 2, 3, 4, 5, 5, 6, 7]}
    for name, stage in pipe.STAGES[:-1]:
        out = stage(spark, d, sf)
        assert out.columns == d.columns, name
        rows = out.collect()
        assert all(r[c] == f"{c}!" for r in rows for c in names), name
        assert None in {r.doc_id for r in rows}
        if stage in want:
            assert sorted((r.doc_id for r in rows), key=lambda x: x or 0) == want[stage], name
    assert len(pipe.mixture(spark, d, sf).collect()) == len(EDGE)
