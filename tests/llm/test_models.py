"""Language ID, license scan, context-tree scores and toxicity grades."""

import math
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.llm import common, context_tree, language_id, license_scan, ordinal_toxicity
from tests.conftest import SF_CHECK
from tests.llm import brute
from tests.llm.conftest import EDGE, documents

# ---- language ---------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (brute.fold(r["doc_id"], 3) == 1) for r in out)
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_edge(spark, edge, empty):
    out = language_id.identify(edge)
    got = out.collect()
    assert len(got) == len(EDGE) and language_id.identify(empty).count() == 0
    no_letter = sorted(str(d) for d, t in EDGE if not any(c.isalpha() for c in t or ""))
    assert sorted(str(r["doc_id"]) for r in got if r["lang_pred"] == "und") == no_letter
    none = language_id.identify(edge.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and {r["score"] for r in none} == {0.0}


def test_language_rejects_far_texts(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = language_id.fit(docs.select("doc_id", "text", "lang"), F.lit(True))
    odd = spark.createDataFrame([(1, "zq xj vk wq zx qj kv xz " * 20)], "doc_id long, text string")
    assert language_id.predict(odd, model).first()["rejected"]
    own = language_id.predict(docs, model).agg(F.avg(F.col("rejected").cast("double"))).first()[0]
    assert own < 0.1


# ---- licenses ---------------------------------------------------------------------------------


def check_licenses(df, rows):
    out = sorted((tuple(r) for r in license_scan.scan(df).collect()), key=repr)
    want = []
    for d, t in rows:
        n, k, first, last, base = brute.phrases(t, license_scan.PHRASES)
        labels, score = brute.templates(t, license_scan.TEMPLATES, license_scan.THRESHOLD)
        want.append((d, n, k, first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
    assert out == sorted(want, key=repr)


def test_licenses(edge, empty, small):
    check_licenses(edge, EDGE)
    check_licenses(small[0], small[1])
    assert license_scan.scan(empty).count() == 0


def test_license_containment(spark):
    rng = np.random.default_rng(2)
    notice = license_scan.TEMPLATES[1][1].split()
    rows = []
    for i in range(60):
        keep = [w for w in notice if rng.random() > i / 120]
        rows.append((i, "some words\n" + " ".join(rng.permutation(keep + ["other"] * (i % 7))) + "\nmore"))
    check_licenses(documents(spark, rows), rows)


# ---- context trees ----------------------------------------------------------------------------


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 3.7, 10, 1234.5])
    assert np.allclose(context_tree.log_gamma(x), [math.lgamma(v) for v in x], atol=1e-9)


def test_tree_equals_recursion():
    """The vectorised tree equals context-tree weighting written as a recursion, with every context kept."""
    texts = [b"abracadabra", b"abba", b"", b"banana"]
    depth = 2
    data = []
    for t in texts:
        s = [context_tree.END] * depth + list(t) + [context_tree.END]
        data += [(tuple(s[i - depth:i]), s[i]) for i in range(depth, len(s))]

    def stats(context, prefix):
        k = len(prefix)
        zero = one = 0
        for c, s in data:
            bits = f"{s:08b}"
            if (not context or c[-len(context):] == context) and bits.startswith(prefix):
                zero, one = zero + (bits[k] == "0"), one + (bits[k] == "1")
        return zero, one

    def kt(z, o):
        return math.lgamma(z + .5) + math.lgamma(o + .5) - math.lgamma(z + o + 1) - math.log(math.pi)

    def weighted(context, prefix):
        z, o = stats(context, prefix)
        if len(context) == depth or z + o == 0:
            return kt(z, o)
        children = sum(weighted((c,) + context, prefix) for c in range(256) if any(stats((c,) + context, prefix)))
        return math.log(.5) + np.logaddexp(kt(z, o), children)

    def predict(context, prefix, full):
        z, o = stats(context, prefix)
        own = (o + .5) / (z + o + 1)
        if len(context) == depth:
            return own
        below = full[len(full) - len(context) - 1:]
        if not any(stats(below, prefix)):
            return own
        share = math.exp(math.log(.5) + kt(z, o) - weighted(context, prefix))
        return share * own + (1 - share) * predict(below, prefix, full)

    tables = []
    for d in range(depth + 1):
        count = {}
        for c, s in data:
            key = 0
            for x in reversed(c[depth - d:]):
                key = key << 8 | x
            count[(key, s)] = count.get((key, s), 0) + 1
        k = sorted(count)
        tables.append((np.array([a for a, _ in k], np.uint64), np.array([b for _, b in k]), np.array([count[x] for x in k], float)))
    levels = context_tree.build_tree(tables)
    for c, s in list(product(sorted({c for c, _ in data}), [ord("a"), ord("b"), ord("z"), context_tree.END]))[:60]:
        want = 0.0
        for k in range(8):
            bits = f"{s:08b}"
            p = predict((), bits[:k], c) if any(stats((), bits[:k])) else 0.5
            want += math.log10(p if bits[k] == "1" else 1 - p)
        key = 0
        for x in reversed(c):
            key = key << 8 | x
        got = context_tree.log10_of(levels, np.array([key << 8 | s], np.uint64))[0]
        assert got == pytest.approx(want, abs=1e-4), (c, s)
    keys = (np.uint64(ord("a") << 16 | ord("b") << 8) | np.arange(256, dtype=np.uint64))
    assert (10 ** context_tree.log10_of(levels, keys)).sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("frequent", [1 << 20, 4, 0])
def test_unigram_baseline(edge, frequent):
    out = context_tree.score(edge, ~common.held_out(F.col("doc_id"), 5), frequent=frequent).collect()
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out), key=repr)
    assert got == sorted(((d, a, b, c, round(e, 6)) for d, a, b, c, e in brute.unigram(EDGE)), key=repr)
    assert all(r["score"] < 0 for r in out)


def test_context_tree_small_table(spark, small, empty):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    learn = ~common.held_out(F.col("doc_id"), 5)
    out = context_tree.score(docs, learn).withColumn("held", common.held_out(F.col("doc_id"), 5)).collect()
    held = [r for r in out if r["held"]]
    assert sum(r["score"] for r in held) > 1.05 * sum(r["base_score"] for r in held)
    bits = -sum(r["score"] for r in held) / sum(r["n_bytes"] for r in held) / math.log10(2)
    assert bits < 3.0
    pruned = context_tree.score(docs, learn, most=300).collect()
    assert sum(r["score"] for r in pruned) < sum(r["score"] for r in out)
    assert context_tree.score(empty, learn).count() == 0
    nothing = context_tree.score(docs.limit(20), F.lit(False)).collect()
    assert all(r["score"] == pytest.approx(8 * (r["n_bytes"] + 1) * math.log10(0.5)) and r["n_known"] == 0 for r in nothing)


# ---- toxicity ---------------------------------------------------------------------------------


def test_toxicity_small_table(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    out = ordinal_toxicity.grade_documents(docs, labels)
    bad = F.lower("text").rlike("\\b(idiot|stupid|loser|trash|moron|scum|clown|pathetic|worthless|disgusting)\\b")
    joined = out.join(docs.select("doc_id", "text"), "doc_id").withColumn("bad", bad)
    r = joined.agg(F.avg(F.when(F.col("bad"), F.col("rejected").cast("int"))), F.avg(F.when(~F.col("bad"), F.col("rejected").cast("int"))),
                   F.min("severity"), F.max("severity")).first()
    assert r[0] > 0.97 and r[1] < 0.01 and r[2] >= 0 and r[3] <= 2


def test_toxicity_edge(spark, edge, empty):
    labels = spark.createDataFrame([(10, 1, 0), (14, 1, 1), (14, 0, 0), (15, 1, None), (16, None, 0), (17, 0, 1), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int").withColumn("grade", F.lit("clash"))
    out = ordinal_toxicity.grade_documents(edge, labels)
    assert out.count() == len(EDGE) and ordinal_toxicity.grade_documents(empty, labels).count() == 0
    left = ordinal_toxicity.drop_toxic(edge, labels)
    assert left.columns == edge.columns
    assert ordinal_toxicity.drop_toxic(edge, labels.limit(0)).count() == len(EDGE)


def test_ordinal_fit_recovers_order():
    """More of a word that goes with higher grades gives a higher expected grade; thresholds rise."""
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3)) < [0.3, 0.3, 0.3]
    latent = x @ np.array([2.0, -2.0, 0.0]) + rng.logistic(size=3000)
    grade = (latent > 1).astype(int) + (latent > 3)
    row, col = np.nonzero(x)
    w, t = ordinal_toxicity.solve(grade, row, col, 3, steps=800, ridge=0)
    assert t[1] > t[0]
    assert np.allclose(w, [2, -2, 0], atol=0.35) and np.allclose(t, [1, 3], atol=0.3)
