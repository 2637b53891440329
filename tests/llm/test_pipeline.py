"""The pipeline against its stages done by hand, and the registry."""

import importlib.util

import pytest

from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import EDGE


def test_pipeline_small_table(spark):
    import corpus_pipeline as P
    from colonnade.llm import ordinal_toxicity, tokens

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    gone = {r["doc_id"] for r in ordinal_toxicity.grade_documents(docs, labels).filter("rejected").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in gone]
    rows = [r for r, e in zip(rows, brute.exact(rows)) if e[3]]
    rows = [r for r, e in zip(rows, brute.near(rows, 5)) if e[2] == r[0]]
    rows = [r for r, e in zip(rows, brute.leaks(rows, items)) if not e[5]]
    enc = tokens.PieceEncoder(tokens.vocabulary_path())
    want = {d: len(x) + 1 for (d, _), x in zip(rows, enc.encode([t for _, t in rows]))}
    got = {}
    for r in P.run(spark, SF_SMALL).collect():
        assert r["doc_tokens"] == want[r["doc_id"]]
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_stages_keep_columns(spark, edge, empty):
    import corpus_pipeline as P

    for table in (edge, empty):
        docs = table
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()


def test_registry():
    import __spark_entry__ as E

    names = E.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))


@pytest.mark.parametrize("module", ["colonnade", "colonnade.catalog"])
def test_library_does_not_import_llm(module):
    import pathlib

    root = pathlib.Path(importlib.util.find_spec("colonnade").origin).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "colonnade.llm" not in p.read_text(), p


def test_edge_rows_cover_the_cases():
    assert any(d is None for d, _ in EDGE) and any(t is None for _, t in EDGE) and any(t == "" for _, t in EDGE)
