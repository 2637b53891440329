"""Exact and near duplicates, repeated strings and benchmark leaks against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.llm import chosen_path, decontaminate, fuse_dedup, suffix_dedup
from tests.llm import brute
from tests.llm.conftest import BASE, EDGE, PASSAGE, documents


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
LEAKS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
REPEATS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_exact_dedup(edge, batches):
    same(rows(fuse_dedup.dedup(edge, batches), *EXACT), brute.exact(EDGE))


def test_exact_dedup_compares_bytes(edge):
    """With a digest that almost all texts share, groups are still those of equal texts."""
    same(rows(fuse_dedup.dedup(edge, 2, lambda t: (F.length(t) % 2).cast("string")), *EXACT), brute.exact(EDGE))


def test_exact_dedup_empty_and_drop(edge, empty):
    assert fuse_dedup.dedup(empty).count() == 0
    left = fuse_dedup.drop_duplicates(edge)
    assert left.columns == edge.columns
    want = {(d, t) for d, t, k in zip((d for d, _ in EDGE), (x[4] for x in brute.exact(EDGE)), brute.exact(EDGE)) if k[3]}
    assert sorted(rows(left, "doc_id"), key=repr) == sorted([(d,) for d, _ in want], key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_binary_fuse(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    f = fuse_dedup.BinaryFuse.build(keys)
    assert f.contains(keys).all()
    other = np.random.default_rng(n + 1).integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert f.contains(other).mean() < 0.01


@pytest.mark.parametrize("kwargs", [{}, {"small": 2}, {"small": 2, "depth": 1}, {"small": 3, "depth": 2, "trees": 16}])
def test_near_duplicates_small_table(small, kwargs):
    df, data = small
    same(rows(chosen_path.near_duplicates(df, **kwargs), "doc_id", "n_shingles", "component_id"), brute.near(data, 4))


def test_near_duplicates_edge(edge, empty):
    out = chosen_path.near_duplicates(edge)
    same(rows(out, "doc_id", "n_shingles", "component_id"), brute.near(EDGE, 4))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())
    assert chosen_path.near_duplicates(empty).count() == 0
    assert chosen_path.drop_near_duplicates(edge).columns == edge.columns


def test_near_duplicates_dense_groups(spark):
    """Many near copies of one text, and a chain whose ends are far apart, with nodes that stay large."""
    words = [f"w{i}" for i in range(300)]
    data = []
    for i in range(150):
        w = list(words)
        for k in range(3):
            w[(i * 7 + k * 41) % 300] = f"c{i}_{k}"
        data.append((1000 + i, " ".join(w)))
    for i in range(40):
        data.append((2000 + i, " ".join([f"z{k}" for k in range(i * 5, i * 5 + 100)])))
    df = documents(spark, data)
    want = brute.near(data, 4)
    same(rows(chosen_path.near_duplicates(df, small=8), "doc_id", "n_shingles", "component_id"), want)


def test_near_duplicates_recall(small):
    """Every link of similarity 0.8 or more is found at the target rate."""
    assert chosen_path.recall(0.8) > 0.99999
    assert chosen_path.recall(0.8, depth=4) > 0.99
    assert chosen_path.recall(0.8, depth=chosen_path.DEPTH) >= chosen_path.RECALL > chosen_path.recall(0.8, chosen_path.TREES - 1, chosen_path.DEPTH)
    assert chosen_path.trees_for(0.99, 0.5, 1) == 7


def test_recall_at_the_full_depth(spark):
    """Planted pairs at the threshold in nodes that all branch (leaves of one set): the links found are those of all pairs."""
    rng = np.random.default_rng(6)
    data = []
    for i in range(120):
        words = [f"p{i}_{k}" for k in range(60)]
        other = list(words)
        other[:1] = [f"o{i}"] if i % 2 else [f"o{i}", f"q{i}"]
        data += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other[: 60 - int(rng.integers(0, 5))]))]
    got = rows(chosen_path.near_duplicates(documents(spark, data, extra=False), small=1), "doc_id", "n_shingles", "component_id")
    want = brute.near(data, 4)
    assert sum(d != c for d, _, c in want) > 60
    same(got, want)


def test_repeats_small_table(small):
    df, data = small
    same(rows(suffix_dedup.remove_repeats(df), *REPEATS), brute.repeats(data))


@pytest.mark.parametrize("kwargs", [{}, {"block": 500}, {"most_runs": 1}])
def test_repeats_edge(edge, empty, kwargs):
    same(rows(suffix_dedup.remove_repeats(edge, **kwargs), *REPEATS), brute.repeats(EDGE))
    assert suffix_dedup.remove_repeats(empty, **kwargs).count() == 0


def test_repeats_periodic_and_shifted(spark):
    rng = np.random.default_rng(5)
    noise = lambda n: "".join(rng.choice(list("abcdefg "), n))
    shared = noise(260)
    data = [(i, noise(150 + i) + shared[i % 40:] + noise(90)) for i in range(30)] + [(100, "ab" * 400), (101, noise(199)), (102, "q" * 200), (103, "q" * 201)]
    for kwargs in ({}, {"block": 300}, {"most_runs": 2}):
        same(rows(suffix_dedup.remove_repeats(documents(spark, data), **kwargs), *REPEATS), brute.repeats(data))


def test_difference_cover():
    cover = suffix_dedup.COVER
    assert {(a - b) % suffix_dedup.PERIOD for a in cover for b in cover} == set(range(suffix_dedup.PERIOD))
    assert suffix_dedup.SHIFT.max() < suffix_dedup.PERIOD


def test_suffix_order():
    """The block sort orders suffixes as Python does."""
    rng = np.random.default_rng(3)
    body = bytes(rng.choice(list(b"ab"), 400)) * 3 + bytes(rng.choice(list(b"abc"), 600))
    text = np.frombuffer(body + bytes(2 * suffix_dedup.RANKED + 4 * suffix_dedup.PERIOD), np.uint8)
    at = np.arange(len(body) - 300)
    got, _ = suffix_dedup.sort_suffixes(text, at)
    key = lambda i: bytes(text[i:i + suffix_dedup.RANKED])
    assert [key(i) for i in got] == sorted(map(key, at))


ITEMS = [(1, PASSAGE), (2, "one"), (3, None), (4, ""), (5, BASE), (5, BASE), (6, "Seven small birds sing"), (None, "two words"), (7, PASSAGE.lower()), (8, "1 2")]


def test_leaks_small_table(spark, small):
    from tests.conftest import SF_SMALL

    df, data = small
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = brute.leaks(data, [(r["item_id"], r["text"]) for r in items.collect()])
    same(rows(decontaminate.report(df, items), *LEAKS), want)


def test_leaks_edge(spark, edge, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("word", F.lit("clash"))
    same(rows(decontaminate.report(edge, items), *LEAKS), brute.leaks(EDGE, ITEMS))
    assert decontaminate.report(empty, items).count() == 0
    same(rows(decontaminate.report(edge, items.limit(0)), *LEAKS), brute.leaks(EDGE, []))
    left = decontaminate.drop_contaminated(edge, items)
    assert left.columns == edge.columns
    assert left.count() == sum(not x[5] for x in brute.leaks(EDGE, ITEMS))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha " + "x " * 40 + "beta gamma"), (4, "alpha beta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    terms, _ = decontaminate.windows_of(items)
    postings = decontaminate.build_index(docs, terms.select("word").distinct())
    ranked = decontaminate.ranked_terms(terms, postings)
    assert sorted(r["doc"] for r in decontaminate.proximity_matches(postings, ranked, slop=10).collect()) == [1, 2]
    assert decontaminate.phrase_matches(postings, ranked).count() == 0
