"""Histogram trees grown level by level for many trees at once: boosting with arbitrary losses, bagging with out-of-bag scores.

Features are binned once (bounded edges per feature) and written as small integers. A level of all trees is one pass: each
task routes its rows through the partial trees and sums gradients, hessians and counts by (tree, node, feature, bin) in
numpy; Spark adds the sums of the tasks, and the best split of each (tree, node) comes from running sums over the bins of a feature
and a maximum over all splits. The driver gets one row for each node of a level, and keeps the trees (arrays of fixed size).

Trees of a pass share the rows: for bagging a tree is a bag, whose row weights are Poisson counts (or draws without replacement)
from a hash of the row's key and the bag, so out-of-bag rows are known again when scoring; for boosting on several classes a tree is
a class. Raw predictions are written every ``KEPT`` rounds, so a pass never walks through more than that many trees a row.

Where the gradient is linear in the label (squared, Poisson and logistic loss), rows that fall into the same bins of all features add
up to their number and mean label: these cells are written once, and the rounds of boosting pass over them instead of the rows.

Rows with a null label take no part in fitting. A missing feature value (null or NaN) goes to the first bin, that of the
smallest values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.session import materialize

CELLS = 1 << 21  # sums that a task holds at once; more trees of a level are grown in further passes
KEPT = 10  # rounds between written raw predictions


# ---- binning ----------------------------------------------------------------------------------


def edges_of(df: DataFrame, cols: Sequence[str], max_bins: int = 255) -> list[np.ndarray]:
    """Upper edges of the bins of each feature but the last: at most ``max_bins`` - 1 quantiles of its values."""
    probs = [k / max_bins for k in range(1, max_bins)]
    value = lambda c: F.when(F.isnan(F.col(c).cast("double")), None).otherwise(F.col(c).cast("double"))
    row = df.agg(*[F.percentile_approx(value(c), probs, 100 * max_bins).alias(f"q{i}") for i, c in enumerate(cols)],
                 *[F.max(value(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    out = []
    for i in range(len(cols)):
        edges = np.unique(np.array(row[f"q{i}"] or [], float))
        out.append(edges[edges < row[f"m{i}"]] if row[f"m{i}"] is not None else edges)
    return out


def bin_codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of edges below it; missing values are in bin 0."""
    out = np.empty(x.shape, np.int16)
    for f, e in enumerate(edges):
        out[:, f] = np.searchsorted(e, np.where(np.isnan(x[:, f]), -np.inf, x[:, f]), "left")
    return out


def columns_matrix(batch: pa.RecordBatch, cols: Sequence[str]) -> np.ndarray:
    out = np.empty((batch.num_rows, len(cols)))
    for f, c in enumerate(cols):
        out[:, f] = batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return out


def binned_rows(df: DataFrame, cols: Sequence[str], edges: list[np.ndarray], keep: Sequence[str]) -> DataFrame:
    """``keep`` and the list column bins."""

    def run(batches):
        for b in batches:
            codes = bin_codes(columns_matrix(b, cols), edges)
            n, d = codes.shape
            yield pa.record_batch([*[b.column(c) for c in keep], pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), pa.array(codes.ravel()))], [*keep, "bins"])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("bins", T.ArrayType(T.ShortType()))])
    return df.select(*dict.fromkeys([*keep, *cols])).mapInArrow(run, schema)


def codes_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // len(column) if len(column) else 0)


# ---- trees ------------------------------------------------------------------------------------


@dataclass
class Trees:
    """``t`` trees with nodes numbered as in a heap: the children of i are 2 i + 1 and 2 i + 2."""

    feature: np.ndarray  # (t, nodes), -1 where a node is a leaf
    cut: np.ndarray  # (t, nodes): bins up to it go left
    value: np.ndarray  # (t, nodes, outputs)

    @classmethod
    def empty(cls, t: int, depth: int, outputs: int) -> Trees:
        nodes = 2 ** (depth + 1) - 1
        return cls(np.full((t, nodes), -1, np.int32), np.zeros((t, nodes), np.int32), np.zeros((t, nodes, outputs)))

    def leaves(self, codes: np.ndarray, t: int) -> np.ndarray:
        """The node in which each row ends."""
        node = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        for _ in range(int(math.log2(self.feature.shape[1] + 1)) - 1):
            f = self.feature[t, node]
            node = np.where(f >= 0, 2 * node + 1 + (codes[rows, np.maximum(f, 0)] > self.cut[t, node]), node)
        return node

    def predict(self, codes: np.ndarray, t: int) -> np.ndarray:
        return self.value[t, self.leaves(codes, t)]


def grow(rows: DataFrame, columns: Sequence[str], stats: Callable, t: int, outputs: int, n_bins: int, n_features: int, depth: int,
         least: float = 1, ridge: float = 0.0, allowed: np.ndarray | None = None, cells: int = CELLS) -> Trees:
    """``t`` trees on ``rows`` (bins and ``columns``). ``stats(batch, codes, tree)`` gives for each row its count, hessian and the
    gradients of the ``outputs`` (an array with 2 + outputs columns; rows of count 0 take no part). A split maximises the sum over
    outputs of G^2 / (H + ridge) of both sides and needs ``least`` counts on each; leaves get -G / (H + ridge). ``allowed``
    (t, features) says which features a tree may use."""
    trees = Trees.empty(t, depth, outputs)
    open_nodes = [{0} for _ in range(t)]
    width = 2 + outputs
    names = [f"s{i}" for i in range(width)]
    for level in range(depth):
        first = 2 ** level - 1
        per_tree = 2 ** level * n_features * n_bins * width
        at_once = max(1, cells // per_tree)
        todo = [k for k in range(t) if open_nodes[k]]
        found = []
        for begin in range(0, len(todo), at_once):
            found += splits_of(rows, columns, stats, trees, [(k, sorted(open_nodes[k])) for k in todo[begin:begin + at_once]], first, 2 ** level, width, names, n_bins, n_features, least, ridge, allowed)
        open_nodes = [set() for _ in range(t)]
        for r in found:
            k, node = r["tree"], r["node"]
            total = np.array([r[f"t{i}"] for i in range(width)])
            if level == 0:
                trees.value[k, node] = -total[2:] / max(total[1] + ridge, 1e-300)
            if r["feature"] is None:
                continue
            left = np.array([r[f"l{i}"] for i in range(width)])
            trees.feature[k, node], trees.cut[k, node] = r["feature"], r["bin"]
            for child, side in ((2 * node + 1, left), (2 * node + 2, total - left)):
                trees.value[k, child] = -side[2:] / max(side[1] + ridge, 1e-300)
                open_nodes[k].add(child)
    return trees


def splits_of(rows, columns, stats, trees, wanted, first, n_nodes, width, names, n_bins, n_features, least, ridge, allowed) -> list:
    """One pass: the best split of every open node of the ``wanted`` trees (tree, nodes); feature is null where none helps."""

    def run(batches):
        sums = {k: np.zeros((width, n_nodes * n_features * n_bins)) for k, _ in wanted}
        for b in batches:
            if not b.num_rows:
                continue
            codes = codes_matrix(b.column("bins")).astype(np.int64)
            for k, nodes in wanted:
                node = trees.leaves(codes, k)
                s = stats(b, codes, k)
                use = np.isin(node, nodes) & (s[:, 0] > 0)
                if use.any():
                    base = (node[use] - first) * (n_features * n_bins)
                    for f in range(n_features):
                        if allowed is None or allowed[k, f]:
                            at = base + f * n_bins + codes[use, f]
                            for i in range(width):
                                sums[k][i] += np.bincount(at, s[use, i], sums[k].shape[1])
        for k, total in sums.items():
            at = np.flatnonzero(total[0])
            cell, b = np.divmod(at, n_bins)
            node, f = np.divmod(cell, n_features)
            yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array((node + first).astype(np.int32)), pa.array(f.astype(np.int32)), pa.array(b.astype(np.int32)),
                                   *[pa.array(total[i][at]) for i in range(width)]], ["tree", "node", "feature", "bin", *names])

    schema = "tree int, node int, feature int, bin int, " + ", ".join(f"{c} double" for c in names)
    parts = rows.select("bins", *columns).mapInArrow(run, schema)
    cells = parts.groupBy("tree", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in names])
    running = cells
    for i, c in enumerate(names):
        running = running.withColumn(f"l{i}", F.expr(f"sum({c}) OVER (PARTITION BY tree, node, feature ORDER BY bin)")).withColumn(f"t{i}", F.expr(f"sum({c}) OVER (PARTITION BY tree, node, feature)"))
    score = lambda g, h: sum((x * x for x in g[1:]), g[0] * g[0]) / F.greatest(h + F.lit(float(ridge)), F.lit(1e-12))
    left, total = [F.col(f"l{i}") for i in range(width)], [F.col(f"t{i}") for i in range(width)]
    right = [a - b for a, b in zip(total, left)]
    gain = score(left[2:], left[1]) + score(right[2:], right[1]) - score(total[2:], total[1])
    fits = (left[0] >= least) & (right[0] >= least)
    small = 1e-10 * (1 + score(total[2:], total[1]))
    gain = F.when(fits & (gain > small), F.round(gain, 9)).otherwise(F.lit(-1.0))
    running = running.select("tree", "node", "feature", "bin", *[f"l{i}" for i in range(width)], *[f"t{i}" for i in range(width)], gain.alias("gain"))
    best = running.groupBy("tree", "node").agg(F.max_by(F.struct("feature", "bin", "gain", *[f"l{i}" for i in range(width)], *[f"t{i}" for i in range(width)]),
                                                        F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("b"))
    good = F.col("b.gain") > 0
    return best.select("tree", "node", F.when(good, F.col("b.feature")).alias("feature"), F.col("b.bin").alias("bin"),
                       *[F.col(f"b.l{i}").alias(f"l{i}") for i in range(width)], *[F.col(f"b.t{i}").alias(f"t{i}") for i in range(width)]).collect()


# ---- boosting ---------------------------------------------------------------------------------


def softmax(raw: np.ndarray) -> np.ndarray:
    e = np.exp(raw - raw.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


#: loss -> (gradient, hessian) of the raw predictions (n, trees of a round) and the labels.
LOSSES: dict[str, Callable] = {
    "squared": lambda raw, y: (raw - y[:, None], np.ones_like(raw)),
    "absolute": lambda raw, y: (np.sign(raw - y[:, None]), np.ones_like(raw)),
    "poisson": lambda raw, y: (np.exp(raw) - y[:, None], np.exp(raw)),
    "logistic": lambda raw, y: ((p := 1 / (1 + np.exp(-raw))) - y[:, None], np.maximum(p * (1 - p), 1e-12)),
    "multinomial": lambda raw, y: ((p := softmax(raw)) - (y[:, None] == np.arange(raw.shape[1])[None, :]), np.maximum(p * (1 - p), 1e-12)),
}
LINEAR = ("squared", "poisson", "logistic")  # gradients linear in the label, hessians without it
LINKS = {"poisson": np.exp, "logistic": lambda raw: 1 / (1 + np.exp(-raw)), "multinomial": softmax}


@dataclass
class Boosted:
    cols: list[str]
    edges: list[np.ndarray]
    loss: str
    start: np.ndarray  # raw prediction before the first tree
    rounds: list[Trees]  # each with one tree for every output; values include the learning rate
    labels: list | None = None

    def raw(self, codes: np.ndarray, stages: Sequence[int]) -> list[np.ndarray]:
        raw = np.tile(self.start, (len(codes), 1))
        out = {0: raw.copy()}
        for m, trees in enumerate(self.rounds[:max(stages)], 1):
            for k in range(len(self.start)):
                raw[:, k] += trees.predict(codes, k)[:, 0]
            if m in stages:
                out[m] = raw.copy()
        return [out.get(m, raw) for m in stages]

    def staged(self, df: DataFrame, stages: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and stage_m, the predicted mean after m rounds, for each m of ``stages``."""
        link = LINKS.get(self.loss, lambda raw: raw)

        def run(batches):
            for b in batches:
                values = self.raw(bin_codes(columns_matrix(b, self.cols), self.edges), stages)
                yield pa.record_batch([*[b.column(c) for c in keep], *[pa.array(link(v)[:, 0]) for v in values]], [*keep, *[f"stage_{m}" for m in stages]])

        schema = T.StructType([*[df.schema[c] for c in keep], *[T.StructField(f"stage_{m}", T.DoubleType()) for m in stages]])
        return df.select(*dict.fromkeys([*keep, *self.cols])).mapInArrow(run, schema)

    def classify(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep``, probability (one entry a label) and prediction (the label)."""
        labels = np.array(self.labels, float)

        def run(batches):
            for b in batches:
                raw = self.raw(bin_codes(columns_matrix(b, self.cols), self.edges), [len(self.rounds)])[0]
                p = LINKS[self.loss](raw)
                p = np.column_stack([1 - p[:, 0], p[:, 0]]) if self.loss == "logistic" else p
                n, k = p.shape
                yield pa.record_batch([*[b.column(c) for c in keep], pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(p.ravel())), pa.array(labels[p.argmax(1)])],
                                      [*keep, "probability", "prediction"])

        schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("probability", T.ArrayType(T.DoubleType())), T.StructField("prediction", T.DoubleType())])
        return df.select(*dict.fromkeys([*keep, *self.cols])).mapInArrow(run, schema)


def boost(df: DataFrame, cols: Sequence[str], y: str, loss: str = "squared", learning_rate: float = 0.1, max_iter: int = 20, max_depth: int = 5,
          max_bins: int = 255, least: int = 20, ridge: float = 0.0, labels: list | None = None) -> Boosted:
    """Gradient boosting on ``loss``; for 'multinomial' ``y`` holds 0 to classes - 1 (see ``boost_classes``)."""
    if loss not in LOSSES:
        raise ValueError(f"loss is one of {', '.join(LOSSES)}")
    cols = list(cols)
    base = df.where(F.col(y).isNotNull()).withColumn("_y", F.col(y).cast("double"))
    edges = edges_of(base, cols, max_bins)
    rows = binned_rows(base, cols, edges, ["_y"])
    if loss in LINEAR:
        rows = materialize(rows.groupBy("bins").agg(F.count(F.lit(1)).cast("double").alias("_w"), F.avg("_y").alias("_y"), F.min("_y").alias("_low")), "cells")
        s = rows.agg(F.sum("_w").alias("n"), (F.sum(F.col("_w") * F.col("_y")) / F.sum("_w")).alias("mean"), F.min("_low").alias("low")).first()
    else:
        rows = materialize(rows.withColumn("_w", F.lit(1.0)), "binned")
        s = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_y", 0.5, 100_000).alias("median")).first()
    if not s["n"]:
        raise ValueError("no labelled rows")
    if loss == "poisson" and (s["low"] < 0 or s["mean"] <= 0):
        raise ValueError("Poisson loss needs labels of zero or more, not all zero")
    if loss == "multinomial":
        counts = {int(r["_y"]): r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
        start = np.log(np.array([counts.get(k, 0) for k in range(len(labels))]) / s["n"])
    elif loss == "logistic":
        p = min(max(s["mean"], 1e-12), 1 - 1e-12)
        start = np.array([math.log(p / (1 - p))])
    else:
        start = np.array([math.log(s["mean"]) if loss == "poisson" else s["median"] if loss == "absolute" else s["mean"]])
    k = len(start)
    n_bins = max((len(e) for e in edges), default=0) + 1
    gradient = LOSSES[loss]
    model = Boosted(cols, edges, loss, start, [], labels)
    rows = rows.select("bins", "_y", "_w", F.array(*[F.lit(float(v)) for v in start]).alias("_raw"))
    written: list[Trees] = []  # rounds since the raw predictions were written

    def raw_of(batch, codes, rounds):
        raw = np.array(batch.column("_raw").flatten().to_numpy(zero_copy_only=False), float).reshape(len(codes), k)
        for trees in rounds:
            for j in range(k):
                raw[:, j] += trees.predict(codes, j)[:, 0]
        return raw

    for m in range(1, max_iter + 1):
        rounds = list(written)

        def stats(batch, codes, tree, rounds=rounds):
            g, h = gradient(raw_of(batch, codes, rounds), batch.column("_y").to_numpy())
            w = batch.column("_w").to_numpy()
            return np.column_stack([w, w * h[:, tree], w * g[:, tree]])

        trees = grow(rows, ["_y", "_w", "_raw"], stats, k, 1, n_bins, len(cols), max_depth, least, ridge)
        if loss == "absolute":
            set_medians(rows, trees, lambda b, c, rounds=rounds: b.column("_y").to_numpy() - raw_of(b, c, rounds)[:, 0])
        trees.value *= learning_rate
        model.rounds.append(trees)
        written.append(trees)
        if len(written) == KEPT and m < max_iter:
            done = list(written)

            def advance(batches, done=done):
                for b in batches:
                    if b.num_rows:
                        raw = raw_of(b, codes_matrix(b.column("bins")), done)
                        yield pa.record_batch([b.column("bins"), b.column("_y"), b.column("_w"), pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1) * k, pa.int32()), pa.array(raw.ravel()))], ["bins", "_y", "_w", "_raw"])

            rows = materialize(rows.mapInArrow(advance, "bins array<short>, _y double, _w double, _raw array<double>"), "raw-predictions")
            written = []
    return model


def set_medians(rows: DataFrame, trees: Trees, residual: Callable) -> None:
    """Leaf values of the only tree: the (approximate) median of the residuals in each leaf."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                codes = codes_matrix(b.column("bins"))
                yield pa.record_batch([pa.array(trees.leaves(codes, 0)), pa.array(residual(b, codes))], ["node", "r"])

    for r in rows.mapInArrow(run, "node long, r double").groupBy("node").agg(F.percentile_approx("r", 0.5, 10_000).alias("m")).collect():
        trees.value[0, r["node"], 0] = r["m"]


def boost_classes(df: DataFrame, cols: Sequence[str], label: str, **kwargs) -> Boosted:
    """Boosting on the logistic loss: one tree a round for two labels, one for each label for more. Labels are numbers; their set
    is bounded (``most`` labels) and goes to the driver."""
    most = kwargs.pop("most", 1000)
    labels = sorted(r[0] for r in df.select(F.col(label).cast("double")).where(F.col(label).isNotNull()).distinct().limit(most + 1).collect())
    if not 2 <= len(labels) <= most:
        raise ValueError(f"{len(labels)} labels; 2 to {most} are possible")
    number = F.lit(None).cast("double")
    for i, v in enumerate(labels):
        number = F.when(F.col(label).cast("double") == v, F.lit(float(i))).otherwise(number)
    return boost(df.withColumn("_label", number), cols, "_label", "logistic" if len(labels) == 2 else "multinomial", labels=labels, **kwargs)


# ---- bagging ----------------------------------------------------------------------------------


def bag_weights(key: np.ndarray, bag: int, rate: float, bootstrap: bool, seed: int) -> np.ndarray:
    """Row weights of a bag from 64-bit hashes of the row keys: Poisson(rate) counts with ``bootstrap``, else 0 or 1 with
    probability ``rate``. The same for a row whenever it is asked."""
    x = key.astype(np.uint64) + np.uint64((seed * 1_000_003 + bag + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = (x >> np.uint64(11)).astype(float) / (1 << 53)
    if not bootstrap:
        return (u < rate).astype(float)
    out, p, total = np.zeros(len(u)), math.exp(-rate), math.exp(-rate)
    for k in range(1, 200):
        more = u >= total
        if not more.any():
            break
        out[more] = k
        p *= rate / k
        total += p
    return out


@dataclass
class Bagged:
    cols: list[str]
    edges: list[np.ndarray]
    labels: list
    trees: Trees
    rate: float
    bootstrap: bool
    seed: int

    def votes(self, codes: np.ndarray, key: np.ndarray | None = None) -> np.ndarray:
        """Votes for each label; with ``key`` only of the bags that do not hold the row."""
        out = np.zeros((len(codes), len(self.labels)))
        rows = np.arange(len(codes))
        for t in range(len(self.trees.feature)):
            vote = self.trees.predict(codes, t).argmax(1)
            own = np.ones(len(codes)) if key is None else bag_weights(key, t, self.rate, self.bootstrap, self.seed) == 0
            out[rows, vote] += own
        return out

    def predict(self, df: DataFrame, keep: Sequence[str] = (), oob_key: str | None = None) -> DataFrame:
        """``keep``, prediction (most votes, ties to the smaller label; null without any) and share (of the votes). With
        ``oob_key``, the column the bags were drawn by, only bags that do not hold a row vote on it."""
        labels = np.array(self.labels, float)
        rows = df.withColumn("_key", F.xxhash64(oob_key)) if oob_key else df

        def run(batches):
            for b in batches:
                v = self.votes(bin_codes(columns_matrix(b, self.cols), self.edges), b.column("_key").to_numpy() if oob_key else None)
                n = v.sum(1)
                yield pa.record_batch([*[b.column(c) for c in keep], pa.array(labels[v.argmax(1)], mask=n == 0), pa.array(v.max(1) / np.maximum(n, 1), mask=n == 0)], [*keep, "prediction", "share"])

        schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("prediction", T.DoubleType()), T.StructField("share", T.DoubleType())])
        return rows.select(*dict.fromkeys([*keep, *self.cols, *(["_key"] if oob_key else [])])).mapInArrow(run, schema)

    def oob_score(self, df: DataFrame, label: str, key: str) -> float:
        """Accuracy of the out-of-bag votes over the rows that have any."""
        out = self.predict(df.where(F.col(label).isNotNull()), [label], key).where(F.col("prediction").isNotNull())
        return out.agg(F.avg((F.col("prediction") == F.col(label).cast("double")).cast("double"))).first()[0]


def bag(df: DataFrame, cols: Sequence[str], label: str, key: str, n_estimators: int = 10, max_samples: float = 1.0, max_features: float | int = 1.0,
        bootstrap: bool = True, max_depth: int = 5, max_bins: int = 255, least: float = 1, seed: int = 0, most: int = 1000) -> Bagged:
    """Bags of classification trees (gini), all grown in the same passes. ``max_samples`` is the share of rows that a bag draws,
    ``max_features`` the share (or number) of features that a tree may use, drawn without replacement."""
    cols = list(cols)
    base = df.where(F.col(label).isNotNull()).withColumn("_y", F.col(label).cast("double")).withColumn("_key", F.xxhash64(key))
    labels = sorted(r[0] for r in base.select("_y").distinct().limit(most + 1).collect())
    if not 1 <= len(labels) <= most:
        raise ValueError(f"{len(labels)} labels; 1 to {most} are possible")
    edges = edges_of(base, cols, max_bins)
    rows = materialize(binned_rows(base, cols, edges, ["_y", "_key"]), "binned")
    d = len(cols)
    take = max(1, min(d, max_features if isinstance(max_features, int) else round(max_features * d)))
    rng = np.random.default_rng(seed)
    allowed = np.zeros((n_estimators, d), bool)
    for t in range(n_estimators):
        allowed[t, rng.permutation(d)[:take]] = True
    names = np.array(labels)

    def stats(batch, codes, tree):
        w = bag_weights(batch.column("_key").to_numpy(), tree, max_samples, bootstrap, seed)
        own = (batch.column("_y").to_numpy()[:, None] == names[None, :]).astype(float)
        return np.column_stack([w, w, -own * w[:, None]])  # a leaf's value is the share of each label

    n_bins = max((len(e) for e in edges), default=0) + 1
    trees = grow(rows, ["_y", "_key"], stats, n_estimators, len(labels), n_bins, d, max_depth, least, 0.0, allowed)
    return Bagged(cols, edges, labels, trees, max_samples, bootstrap, seed)
