"""The context tree holds every context of the training bytes, in however many parts it is built."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.llm import common, context_tree


def whole_tree(texts, depth):
    """Levels from all (context, byte) counts at once, and the keys of each text."""
    keys = []
    for t in texts:
        raw = common.lower_bytes(np.frombuffer(t.encode(), np.uint8))
        keys.append(context_tree.symbol_keys(raw, np.array([0, len(raw)]), depth)[0])
    key, tables = np.concatenate(keys), []
    for d in range(depth + 1):
        pairs = (key >> np.uint64(8 * (depth - d + 1)) if d else key * np.uint64(0)) << np.uint64(8) | key & np.uint64(255)
        pairs, n = np.unique(pairs, return_counts=True)
        tables.append((pairs >> np.uint64(8), pairs & np.uint64(255), n))
    return context_tree.build_tree(tables), keys


def random_texts(n, size, letters):
    rng = np.random.default_rng(7)
    return ["".join(rng.choice(list(letters), size)) for _ in range(n)]


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_parts_equal_the_whole_tree(parts):
    texts = random_texts(6, 150, "abc ")
    levels, keys = whole_tree(texts[:4], 5)
    every, n = np.unique(np.concatenate(keys), return_counts=True)
    asked = np.unique(np.concatenate([*keys, *whole_tree(texts[4:], 5)[1], every ^ np.uint64(3)]))
    count = np.zeros(len(asked), np.int64)
    count[np.searchsorted(asked, every)] = n
    cuts = list(zip(np.array_split(asked, parts), np.array_split(count, parts)))
    closed = context_tree.close_nodes([context_tree.grow_part(k, c, 5)[1] for k, c in cuts], 5)
    got = np.concatenate([context_tree.log10_of(context_tree.grow_part(k, c, 5, closed)[0], k) for k, c in cuts])
    assert np.allclose(got, context_tree.log10_of(levels, asked), atol=1e-4)


def test_every_context_is_kept(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "CHUNK", 1 << 16, raising=False)
    monkeypatch.setattr(context_tree, "PART_ROWS", 1 << 16, raising=False)
    texts = [2 * t for t in random_texts(8, 15_000, "abcdefghijklmnopqrstuvwxyz0123456789 ")]
    levels, keys = whole_tree(texts, 5)
    assert sum(len(x.contexts) for x in levels) > 1 << 17
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r["score"] for r in context_tree.score(docs, F.lit(True)).collect()}
    for i, k in enumerate(keys):
        assert math.isclose(got[i], context_tree.log10_of(levels, k).sum(), rel_tol=1e-5)
