"""Near copies that meet in a dense node only, whose centre is unlike them."""

from colonnade.llm import chosen_path


def test_dense_node_without_other_pairs(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(24)) for x in ("ant", "bee", "cow"))
    texts = [a, b, c, f"{a} {b} {c} last", f"{a} {b} {c} final"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in chosen_path.near_duplicates(docs, trees=1, depth=1, small=2).collect()}
    assert out == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3}
