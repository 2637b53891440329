"""Language identification by the nearest of several centroids of each language.

Texts become vectors of byte n-grams (one to three bytes, hashed to ``DIM`` buckets), weighted by
``1 + ln(count)`` and inverse document frequency and scaled to length 1. Document frequencies cover all
training rows. For each language, spherical k-means over a bounded sample (``SAMPLE`` rows a
language, about) gives ``CLUSTERS`` centroids; a text takes the language of the centroid of largest
cosine. A text farther from it than the centroid's radius (mean and ``REACH`` standard deviations of
its own training rows) is marked ``rejected``; it still names the nearest language.

Defined cases: null text, or text without a letter: ``und``, score 0, rejected. Rows without a language
or a letter are not learned from. With no learned language every text is ``und``. Ties go to the
language first by name. Repeated rows and null doc_ids are predicted row by row; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.llm import common
from colonnade.session import materialize

DIM = 4096
GRAMS = (1, 2, 3)
CLUSTERS = 4
SAMPLE = 1000
ROUNDS = 8
REACH = 3.0
ROWS = 256  # rows that are vectors at once
UNKNOWN = "und"


#: Letters (lowered) and bytes of other alphabets; digits and marks count as blanks.
FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def counts(column: pa.Array) -> np.ndarray:
    """n-gram counts, one row of ``DIM`` for each text, over its words with one blank between two. N-grams never
    cross texts."""
    raw, off = common.utf8(column)
    n = len(off) - 1
    raw = FOLD[raw]
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    keep = np.append(True, (raw[1:] != 32) | (raw[:-1] != 32) | (row[1:] != row[:-1]))[:len(raw)]
    raw, row = raw[keep].astype(np.uint32), row[keep]
    end = np.searchsorted(row, np.arange(n), "right")[row]
    at = np.arange(len(raw))
    out = np.zeros(n * DIM)
    code = np.zeros(len(raw), np.uint32)
    for k in range(max(GRAMS)):
        code = code[:len(raw) - k] | (raw[k:] << np.uint32(8 * k))
        if k + 1 in GRAMS and len(code):
            whole = at[:len(code)] + k < end[:len(code)]
            bucket = ((code[whole] + np.uint32((k + 1) << 24)) * np.uint32(2654435761)) >> np.uint32(32 - 12)
            out += np.bincount(row[:len(code)][whole] * DIM + bucket, minlength=n * DIM)
    return out.reshape(n, DIM)


def vectors(column: pa.Array, idf: np.ndarray) -> np.ndarray:
    x = counts(column)
    there = x > 0
    np.log(x, out=x, where=there)
    x += there
    x *= idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return (x / np.where(norm == 0, 1, norm)).astype(np.float32)


def row_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.pieces(batches, most=1 << 20):
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


@dataclass
class Model:
    langs: list[str]  # of each centroid
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that hold each bucket, and rows, over all training rows. Each partition sends ``DIM`` sums."""

    def run(batches):
        df, n = np.zeros(DIM, np.int64), 0
        for b in row_runs(batches):
            df += (counts(b.column("text")) > 0).sum(0)
            n += b.num_rows
        yield pa.record_batch([pa.array(np.append(np.arange(DIM), -1)), pa.array(np.append(df, n))], ["bucket", "n"])

    rows = training.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = {r["bucket"]: r["n"] for r in rows}
    return np.array([found.get(i, 0) for i in range(DIM)], float), found.get(-1, 0)


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> Model | None:
    """Learn from the rows of ``docs`` (text, lang) where ``learn`` holds."""
    training = docs.filter(learn & docs["lang"].isNotNull() & has_letter(docs["text"]))
    per_lang = {r["lang"]: r["n"] for r in training.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_lang:
        return None
    df, n = document_frequencies(training)
    idf = np.log((1 + n) / (1 + df)) + 1
    part = F.create_map(*[F.lit(x) for lang, k in per_lang.items() for x in (lang, min(1.0, sample / k))])
    mark = F.xxhash64("doc_id", "text")
    chosen = training.withColumn("mark", mark).filter(F.pmod("mark", F.lit(1 << 20)) < part[F.col("lang")] * (1 << 20))

    def embed(batches):
        for b in row_runs(batches):
            x = vectors(b.column("text"), idf)
            yield pa.record_batch([b.column("lang"), b.column("mark"), pa.array([v.tobytes() for v in x], pa.binary())], ["lang", "mark", "v"])

    points = materialize(chosen.select("lang", "mark", "text").mapInArrow(embed, "lang string, mark long, v binary"), "lang-sample")
    langs = sorted(per_lang)
    first = {}  # the first rows of each language by their mark begin the clusters
    begin = points.groupBy("lang").agg(F.slice(F.array_sort(F.collect_set("mark")), 1, clusters).alias("m"))
    for r in points.join(begin, "lang").filter(F.array_contains("m", F.col("mark"))).select("lang", "mark", "v").collect():
        first.setdefault(r["lang"], {})[r["mark"]] = np.frombuffer(r["v"], np.float32)
    names = [lang for lang in langs for _ in first.get(lang, {})]
    centroids = np.stack([v for lang in langs for _, v in sorted(first.get(lang, {}).items())])

    def assign(centroids):
        own = {lang: np.array([i for i, x in enumerate(names) if x == lang]) for lang in set(names)}

        def run(batches):
            sums, size, dist = np.zeros(centroids.shape), np.zeros(len(names)), np.zeros((2, len(names)))
            for b in batches:
                lang = np.array(b.column("lang").to_pylist())
                v = np.stack([np.frombuffer(x.as_buffer(), np.float32) for x in b.column("v")]) if b.num_rows else np.zeros((0, DIM))
                for x in set(lang):
                    mine, k = v[lang == x], own[x]
                    sim = mine @ centroids[k].T
                    best = sim.argmax(1)
                    d = 1 - sim.max(1)
                    np.add.at(sums, k[best], mine)
                    np.add.at(size, k[best], 1)
                    np.add.at(dist[0], k[best], d)
                    np.add.at(dist[1], k[best], d * d)
            used = np.flatnonzero(size)
            yield pa.record_batch([pa.array(used), pa.array([sums[k].tobytes() for k in used], pa.binary()), pa.array(size[used]),
                                   pa.array(dist[0][used]), pa.array(dist[1][used])], ["k", "sums", "size", "d", "dd"])

        sums, size, dist = np.zeros(centroids.shape), np.zeros(len(names)), np.zeros((2, len(names)))
        for r in points.mapInArrow(run, "k long, sums binary, size double, d double, dd double").toLocalIterator():
            sums[r["k"]] += np.frombuffer(r["sums"])
            size[r["k"]] += r["size"]
            dist[:, r["k"]] += r["d"], r["dd"]
        return sums, size, dist

    for _ in range(rounds):
        sums, size, dist = assign(centroids)
        moved = np.where(size[:, None] > 0, sums, centroids)
        moved = (moved / np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)).astype(np.float32)
        still = np.abs(moved - centroids).max() < 1e-5
        centroids = moved
        if still:
            break
    _, size, dist = assign(centroids)
    mean = dist[0] / np.maximum(size, 1)
    radius = mean + REACH * np.sqrt(np.maximum(dist[1] / np.maximum(size, 1) - mean ** 2, 0))
    return Model(names, centroids, radius, idf)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1), cluster and rejected, for each row of ``docs``."""
    kept = docs.select("doc_id", common.text_of(docs).alias("text"), has_letter(docs["text"]).alias("letters"))
    if model is None:
        return kept.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(-1).cast("long").alias("cluster"), F.lit(True).alias("rejected"))
    langs = np.array(model.langs, dtype=object)

    def run(batches):
        for b in row_runs(batches):
            sim = vectors(b.column("text"), model.idf) @ model.centroids.T
            best = sim.argmax(1)
            top = np.clip(sim.max(1).astype(float), 0, 1)
            known = np.array(b.column("letters").to_pylist(), bool)
            yield pa.record_batch([
                b.column("doc_id"), pa.array(np.where(known, langs[best], UNKNOWN).tolist(), pa.string()), pa.array(np.where(known, top, 0.0)),
                pa.array(np.where(known, best, -1)), pa.array(~known | (1 - top > model.radius[best]))],
                ["doc_id", "lang_pred", "score", "cluster", "rejected"])

    kind = dict(docs.dtypes)["doc_id"]
    return kept.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, cluster long, rejected boolean")


def identify(docs: DataFrame, folds: int = 3) -> DataFrame:
    """Fit on the rows whose crc32(doc_id) mod ``folds`` is not 1 and predict all rows."""
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows, ~common.held_out(F.col("doc_id"), folds))
    return predict(rows, model).withColumn("held_out", common.held_out(F.col("doc_id"), folds))
