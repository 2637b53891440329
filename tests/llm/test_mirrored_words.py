"""Long words that a polynomial hash cannot tell apart (letters by the parity of the binary digits of the place, and the mirror),
and texts longer than a piece of a batch."""

import numpy as np
import pytest

from colonnade.llm import chosen_path, common, context_tree, ordinal_toxicity, suffix_dedup, tokens
from tests.llm import brute
from tests.llm.conftest import documents


def parity_word(n, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


PAIRS = [(parity_word(n, a, b), parity_word(n, b, a)) for n in (1024, 2048, 4096) for a, b in ("ab", "xy", "tk")]
ROWS = [(i, t) for i, t in enumerate([w for p in PAIRS for w in p])] + [(100, PAIRS[0][0] + " end"), (101, PAIRS[0][1] + " end"), (102, "plain text")]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, ROWS)


def test_hashes_differ():
    raw = "".join(t for _, t in ROWS).encode()
    ends = np.cumsum([len(t) for _, t in ROWS])
    h = common.span_hashes(np.frombuffer(raw, np.uint8), np.append(0, ends[:-1]), ends)
    assert len(np.unique(h)) == len(ROWS)


def test_hashes_are_of_the_bytes_only():
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 3, 3000).astype(np.uint8)
    size = rng.integers(0, 700, 400)
    start = rng.integers(0, 3000 - size)
    h = common.span_hashes(raw, start, start + size)
    moved = np.concatenate([np.zeros(37, np.uint8), raw, np.zeros(5, np.uint8)])
    assert (h == common.span_hashes(moved, start + 37, start + 37 + size)).all()
    spans = [raw[s:s + n].tobytes() for s, n in zip(start, size)]
    assert len(set(spans)) == len(np.unique(h))
    other = rng.permutation(400)
    n = np.minimum(size, size[other])
    assert (common.same_spans(raw, start, moved, start[other] + 37, n) == [raw[a:a + k].tobytes() == raw[b:b + k].tobytes() for a, b, k in zip(start, start[other], n)]).all()


def test_ids_equal_the_library(monkeypatch):
    e = tokens.PieceEncoder(tokens.vocabulary_path())
    texts = [t for _, t in ROWS]
    for ids, t in zip(e.encode(texts), texts):
        assert (ids == e.whole(t)).all()
    # with a hash that pieces above eight bytes share the ids are still right
    true = common.span_hashes
    monkeypatch.setattr(tokens, "span_hashes", lambda raw, start, end: np.where(end - start > 8, np.uint64(7), true(raw, start, end)))
    e = tokens.PieceEncoder(tokens.vocabulary_path())
    some = ["wonderfully one", "beautifully two wonderfully", "a b c d", "completely other words here"]
    for text in some + [" ".join(some)] + some:
        assert (e.encode([text])[0] == e.whole(text)).all()


def test_near_duplicates_keep_both(docs):
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in chosen_path.near_duplicates(docs).collect())
    assert got == sorted(brute.near(ROWS, 4))
    assert chosen_path.drop_near_duplicates(docs).count() == len(ROWS)


def test_unigrams(docs):
    from pyspark.sql import functions as F

    got = {r["doc_id"]: r for r in context_tree.score(docs, ~common.held_out(F.col("doc_id"), 5)).collect()}
    for d, n, known, total, base in brute.unigram(ROWS):
        assert (got[d]["n_tokens"], got[d]["n_known"], got[d]["train_tokens"]) == (n, known, total)
        assert abs(got[d]["base_score"] - base) < 1e-9 * max(1, abs(base))


def test_toxic_words(spark, docs):
    """A mark that only the mirror holds goes with the label."""
    rows = [(i, PAIRS[0][i % 2] + f" filler{i % 7} and{i % 3}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["rejected"] for r in ordinal_toxicity.grade_documents(documents(spark, rows), labels).collect()}
    assert all(got[i] == bool(i % 2) for i in range(200))


@pytest.mark.parametrize("size", [5 << 20])
def test_texts_above_a_piece(spark, size):
    """One text longer than what a worker takes at once, in the operators that walk over bytes."""
    rng = np.random.default_rng(9)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(4000)]
    long = " ".join(rng.choice(vocabulary, size // 6))
    rows = [(1, long), (2, long[:3000]), (3, "short one"), (4, None)]
    df = documents(spark, rows)
    e = tokens.PieceEncoder(tokens.vocabulary_path())
    assert (e.encode([long])[0] == e.whole(long)).all()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in chosen_path.near_duplicates(df).collect())
    assert got == sorted(brute.near(rows, 4))
    repeats = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeats(df).collect()}
    assert repeats == {d: (n, gone) for d, n, gone, _, _ in brute.repeats(rows)}
