"""Toxicity grades by cumulative-link ordinal regression over sparse word features.

``P(grade > j) = sigmoid(w.x - t_j)`` with one weight vector for all thresholds and rising ``t_j``. Features
are the distinct words of a text (64-bit hashes, so no two words share a weight). Grades come from the
labels, which say toxic or not, and from marker words (words whose toxic share cannot be chance, ``Z``): 0 not
toxic, 1 toxic, 2 toxic with ``SEVERE_WORDS`` different markers or more. The fit sees a bounded sample of labelled
rows (``SAMPLE``, chosen by a hash of the id; equal texts count once); words that fewer than ``LEAST_ROWS``
sampled texts hold, or that go with no label, get weight zero. Scoring runs over all words of all texts.

Defined cases: a null or empty text has no words and gets the base rate; rows without a toxic label are not
learned from; of several labels for a doc_id the most severe holds; without
labels of both kinds nothing is rejected (severity 0); repeated rows and null ids are scored row by row;
other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.llm import common
from colonnade.session import materialize

SAMPLE = 20_000
LEAST_ROWS = 5
Z = 4.0
RIDGE = 1e-4
STEPS = 600
SEVERE_WORDS = 3
REJECT = 0.5  # P(grade > 0) from which a text is rejected
GRADES = 3

IS_SEPARATOR = np.zeros(256, bool)  # words are runs of digits, a-z (after lowering) and bytes from 0x80
IS_SEPARATOR[:0x30] = IS_SEPARATOR[0x3A:0x61] = IS_SEPARATOR[0x7B:0x80] = True


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j), one column for each threshold."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -50, 50)))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word."""
    raw, off = common.utf8(column)
    raw = common.lower_bytes(raw)
    start, end, row = common.words(raw, off, IS_SEPARATOR)
    return row, common.span_hashes(raw, start, end)


def sample_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """mark (a text fingerprint), toxic and words (distinct word hashes) of a bounded, hash-chosen sample of labelled rows, equal
    texts once. Both sides are cut by the same hash of the id before they meet."""
    known = labels.filter("toxic is not null").select(
        F.col("doc_id").alias("label_id"), F.when(F.col("toxic") == 0, 0).otherwise(1).alias("toxic"))
    n = known.count()
    share = min(1.0, most / max(n, 1))
    cut = int(share * (1 << 30))
    mark = lambda c: F.pmod(F.xxhash64(c.cast("string"), F.lit(7)), F.lit(1 << 30)) < cut
    known = known.filter(mark(F.col("label_id"))).groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(docs["doc_id"].alias("id"), common.text_of(docs).alias("text")).filter(mark(F.col("id")))
    joined = rows.join(known, rows["id"] == known["label_id"]).select(known["toxic"], F.xxhash64("text").alias("mark"), "text")

    def run(batches):
        for b in common.pieces(batches):
            row, h = word_hashes(b.column("text"))
            each = [np.unique(x).view(np.int64) for x in np.split(h, np.searchsorted(row, np.arange(1, b.num_rows)))]
            yield pa.record_batch([b.column("toxic"), b.column("mark"), pa.array(each, pa.list_(pa.int64()))], ["toxic", "mark", "words"])

    found = joined.mapInArrow(run, "toxic int, mark long, words array<long>")
    return materialize(found.groupBy("mark").agg(F.max("toxic").alias("toxic"), F.first("words").alias("words")), "toxic-sample")


def word_statistics(rows: DataFrame, n: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of at least ``LEAST_ROWS`` sampled texts whose toxic share cannot be chance, sorted, and which of them are
    markers. Counts and the test are Spark's; the driver gets the words that pass."""
    base = toxic / n
    counts = rows.select(F.explode("words").alias("word"), "toxic").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))
    z = (F.col("hits") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)))
    kept = counts.filter((F.col("n") >= LEAST_ROWS) & (F.abs(z) >= Z)).select("word", (z > 0).alias("marker")).toArrow()
    word = kept.column("word").to_numpy().view(np.uint64)
    order = np.argsort(word)
    return word[order], kept.column("marker").to_numpy()[order].astype(bool)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model | None:
    """Learn weights and thresholds from labelled rows."""
    rows = sample_rows(docs, labels, most)
    n, n_toxic = (int(x or 0) for x in rows.agg(F.count(F.lit(1)), F.sum("toxic")).first())
    if n_toxic in (0, n):
        return None
    word, marker = word_statistics(rows, n, n_toxic)

    def run(batches):  # of each text, the places of its kept words
        for b in batches:
            held = b.column("words")
            at = np.searchsorted(word, h := held.flatten().to_numpy().view(np.uint64))
            hit = word[np.minimum(at, max(len(word) - 1, 0))] == h if len(word) else np.zeros(len(h), bool)
            row = np.repeat(np.arange(b.num_rows), held.value_lengths().to_numpy())[hit]
            ends = np.searchsorted(row, np.arange(b.num_rows + 1))
            yield pa.record_batch([b.column("mark"), b.column("toxic"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at[hit].astype(np.int32)))],
                                  ["mark", "toxic", "at"])

    held = rows.select("mark", "toxic", "words").mapInArrow(run, "mark long, toxic int, at array<int>").toArrow().sort_by("mark").combine_chunks()
    toxic = held.column("toxic").to_numpy() > 0
    at = held.column("at").combine_chunks()
    row, col = np.repeat(np.arange(n, dtype=np.int32), at.value_lengths().to_numpy()), at.flatten().to_numpy()
    markers = np.bincount(row, weights=marker[col], minlength=n)
    grade = np.where(toxic, np.where(markers >= SEVERE_WORDS, 2, 1), 0)
    weights, thresholds = solve(grade, row, col, len(word))
    return Model(word, weights, thresholds)


def solve(grade: np.ndarray, row: np.ndarray, col: np.ndarray, k: int, steps: int = STEPS,
          ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Maximum penalised likelihood by Adam. The second threshold is the first plus exp(gap), so they rise."""
    n = len(grade)
    cuts = np.arange(GRADES - 1)
    target = grade[:, None] > cuts[None, :]
    rate = np.clip(target.mean(0), 1e-4, 1 - 1e-4)
    first = -np.log(rate / (1 - rate))
    theta = np.concatenate([np.zeros(k), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, t = theta[:k], np.cumsum(np.append(theta[k], np.exp(theta[k + 1:])))
        score = np.bincount(row, weights=w[col], minlength=n)
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - t[None, :], -50, 50)))
        up = np.column_stack([np.ones(n), above])  # P(grade >= g)
        down = np.column_stack([above, np.zeros(n)])  # P(grade > g)
        pick = (np.arange(n), grade)
        p = np.maximum(up[pick] - down[pick], 1e-12)
        slope_up, slope_down = (up * (1 - up))[pick] / p, (down * (1 - down))[pick] / p
        g_score = -(slope_up - slope_down)
        g_w = np.bincount(col, weights=g_score[row], minlength=k) / n + ridge * w
        g_t = np.zeros(GRADES - 1)
        np.add.at(g_t, grade[grade > 0] - 1, slope_up[grade > 0])
        np.add.at(g_t, grade[grade < GRADES - 1], -slope_down[grade < GRADES - 1])
        g_t /= n
        tail = np.cumsum(g_t[::-1])[::-1]  # a threshold moves all that follow
        g = np.concatenate([g_w, tail[:1], tail[1:] * np.exp(theta[k + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return theta[:k], np.cumsum(np.append(theta[k], np.exp(theta[k + 1:])))


def score(docs: DataFrame, model: Model | None, prefix: str = "") -> DataFrame:
    """``docs`` with grade (most likely), severity (expected grade), p_toxic and rejected, each name with
    ``prefix`` in front. No shuffle: columns pass through the batches."""
    added = [("grade", T.IntegerType()), ("severity", T.DoubleType()), ("p_toxic", T.DoubleType()), ("rejected", T.BooleanType())]
    names = [prefix + n for n, _ in added]
    if model is None:
        return docs.withColumns(dict(zip(names, (F.lit(0), F.lit(0.0), F.lit(0.0), F.lit(False)))))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, (_, t) in zip(names, added))])

    def run(batches):
        for b in common.pieces(batches):
            row, h = word_hashes(b.column("text"))
            at = np.searchsorted(model.words, h)
            at[at == len(model.words)] = 0
            hit = model.words[at] == h if len(model.words) else np.zeros(len(h), bool)
            pair = np.unique(row[hit] * max(len(model.words), 1) + at[hit])
            total = np.bincount(pair // max(len(model.words), 1), weights=model.weights[pair % max(len(model.words), 1)] if len(pair) else None, minlength=b.num_rows)
            above = model.above(total)
            mass = np.column_stack([np.ones(len(above)), above]) - np.column_stack([above, np.zeros(len(above))])
            yield pa.record_batch([*b.columns, pa.array(mass.argmax(1), pa.int32()), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(above[:, 0] >= REJECT)],
                                  [*b.schema.names, *names])

    return docs.mapInArrow(run, schema)


def grade_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, grade, severity, p_toxic and rejected of every row of ``docs``."""
    model = fit(docs, labels)
    return score(docs.select("doc_id", common.text_of(docs).alias("text")), model).drop("text")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows; all columns stay."""
    return score(docs, fit(docs, labels), "__").filter("not __rejected").select(*[F.col(f"`{c}`") for c in docs.columns])
