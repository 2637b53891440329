"""Feature preparation: scalers, imputers, discretizers, text vectorizers.

``fit`` functions run one (or a few) distributed aggregates and return the
learned statistics as a small Python object (one value per column, bounded
by the number of columns).  ``transform`` functions turn those statistics
into literal column expressions: no join, no broadcast, whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colonnade.functions.columns import missing, nan_to_null
from colonnade.operators.aggregates import quantiles
from colonnade.plans.ordered import CumSum, ordered_scan
from colonnade.session import materialize

# -- standard scaler ----------------------------------------------------------


@dataclass
class ScalerStats:
    cols: list[str]
    mean: dict[str, float]
    scale: dict[str, float]
    n: dict[str, float]
    var: dict[str, float] = field(default_factory=dict)


def _safe_scale(v):
    if v is None:
        return 1.0
    s = math.sqrt(v)
    return 1.0 if s == 0.0 else s


def fit_std_scaler(df: DataFrame, cols: Sequence[str], weight: str | None = None) -> ScalerStats:
    """Mean and population std per column (nulls ignored).  With a weight
    column: weighted mean and variance, seen count = weight sum.  Zero
    variance gives scale 1."""
    cols = list(cols)
    df = nan_to_null(df, cols)
    if weight is None:
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.var_pop(c).alias(f"v_{c}") for c in cols],
                     *[F.count(c).alias(f"n_{c}") for c in cols]).first()
        var = {c: row[f"v_{c}"] for c in cols}
        return ScalerStats(cols, {c: row[f"m_{c}"] for c in cols}, {c: _safe_scale(var[c]) for c in cols},
                           {c: row[f"n_{c}"] for c in cols}, var)
    w = F.col(weight)
    wsum = {c: F.sum(F.when(F.col(c).isNotNull(), w)) for c in cols}
    r1 = df.agg(*[(F.sum(w * F.col(c)) / wsum[c]).alias(f"m_{c}") for c in cols],
                *[wsum[c].alias(f"n_{c}") for c in cols]).first()
    mean = {c: r1[f"m_{c}"] for c in cols}
    r2 = df.agg(*[(F.sum(w * F.pow(F.col(c) - F.lit(mean[c]), 2)) / wsum[c]).alias(f"v_{c}") for c in cols]).first()
    var = {c: r2[f"v_{c}"] for c in cols}
    return ScalerStats(cols, mean, {c: _safe_scale(var[c]) for c in cols}, {c: r1[f"n_{c}"] for c in cols}, var)


def std_scale(df: DataFrame, stats: ScalerStats, with_mean: bool = True, with_std: bool = True) -> DataFrame:
    """``(x - mean) / scale``; nulls and NaN become null."""
    df = nan_to_null(df, stats.cols)
    out = {}
    for c in stats.cols:
        e = F.col(c)
        if with_mean:
            e = e - F.lit(stats.mean[c])
        if with_std:
            e = e / F.lit(stats.scale[c])
        out[c] = e
    return df.withColumns(out)


def std_unscale(df: DataFrame, stats: ScalerStats, with_mean: bool = True, with_std: bool = True) -> DataFrame:
    """Inverse transform ``x * scale + mean``."""
    out = {}
    for c in stats.cols:
        e = F.col(c)
        if with_std:
            e = e * F.lit(stats.scale[c])
        if with_mean:
            e = e + F.lit(stats.mean[c])
        out[c] = e
    return df.withColumns(out)


def batch_moments(df: DataFrame, cols: Sequence[str], batch: str) -> DataFrame:
    """Per-batch (n, mean, M2) for each column: the state an incremental
    scaler keeps, computed for all batches in one aggregate."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"mean_{c}"),
                 (F.var_pop(c) * F.count(c)).alias(f"m2_{c}")]
    return df.groupBy(batch).agg(*aggs)


def merge_moments(moments: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Merge per-batch moments (parallel variance formula): total n, mean,
    population variance.  Two aggregates over the small moments table."""
    tot = moments.agg(*[F.sum(f"n_{c}").alias(f"N_{c}") for c in cols],
                      *[(F.sum(F.col(f"n_{c}") * F.col(f"mean_{c}")) / F.sum(f"n_{c}")).alias(f"M_{c}") for c in cols])
    row = tot.first()
    out = moments.agg(*[
        F.struct(F.lit(row[f"N_{c}"]).cast("bigint").alias("n"), F.lit(row[f"M_{c}"]).alias("mean"),
                 ((F.sum(f"m2_{c}") + F.sum(F.col(f"n_{c}") * F.pow(F.col(f"mean_{c}") - F.lit(row[f"M_{c}"]), 2)))
                  / F.lit(row[f"N_{c}"])).alias("var")).alias(c) for c in cols])
    return out


# -- imputers -----------------------------------------------------------------

@dataclass
class ImputerStats:
    strategy: str
    fill: dict
    dropped: list[str]
    missing_cols: list[str]
    missing_values: object = None


def most_frequent(df: DataFrame, c: str):
    """Most frequent non-null value; ties go to the smallest value."""
    r = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n")) \
        .orderBy(F.col("_n").desc(), F.col(c).asc()).limit(1).collect()
    return r[0][0] if r else None


def _marked(df: DataFrame, cols: Sequence[str], missing_values=None) -> DataFrame:
    """``df`` with NaN, and cells equal to ``missing_values``, as null."""
    df = nan_to_null(df, cols)
    if missing_values is None:
        return df
    return df.withColumns({c: F.when(F.col(c) != F.lit(missing_values), F.col(c)) for c in cols})


def fit_simple_imputer(df: DataFrame, cols: Sequence[str], strategy: str = "mean", fill_value=None,
                       missing_values=None) -> ImputerStats:
    """mean / median / most_frequent / constant.  Columns that are entirely
    missing are dropped, except with the constant strategy (default
    constant 0).  Missing are null, NaN and ``missing_values``.  Counts and means come from one aggregate."""
    cols = list(cols)
    df = _marked(df, cols, missing_values)
    means = [F.avg(c).alias(f"_m_{c}") for c in cols] if strategy == "mean" else []
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in cols], *means).first()
    missing_cols = [c for c in cols if counts[c] < counts["_rows"]]
    fill, dropped = {}, []
    for c in cols:
        if strategy == "constant":
            fill[c] = 0 if fill_value is None else fill_value
            continue
        if counts[c] == 0:
            dropped.append(c)
            continue
        if strategy == "mean":
            fill[c] = counts[f"_m_{c}"]
        elif strategy == "median":
            fill[c] = quantiles(df, c, [0.5]).first()["value"]
        elif strategy == "most_frequent":
            fill[c] = most_frequent(df, c)
        else:
            raise ValueError(strategy)
    return ImputerStats(strategy, fill, dropped, missing_cols, missing_values)


def impute(df: DataFrame, stats: ImputerStats, add_indicator: bool = False, suffix: str = "_missing") -> DataFrame:
    out = _marked(df, [*stats.fill, *stats.dropped], stats.missing_values)
    if add_indicator:
        out = out.withColumns({f"{c}{suffix}": F.col(c).isNull().cast("int") for c in stats.missing_cols})
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in stats.fill.items()})
    return out.drop(*stats.dropped)


def unimpute(df: DataFrame, stats: ImputerStats, suffix: str = "_missing") -> DataFrame:
    """Restore missing cells from the indicator columns (needs them)."""
    for c in stats.missing_cols:
        if f"{c}{suffix}" not in df.columns:
            raise ValueError("inverse_transform needs add_indicator=True")
    return df.withColumns({c: F.when(F.col(f"{c}{suffix}") == 1, F.lit(None)).otherwise(F.col(c))
                           for c in stats.missing_cols if c in df.columns})


def fit_missing_indicator(df: DataFrame, cols: Sequence[str], features: str = "missing-only") -> list[str]:
    if features == "all":
        return list(cols)
    counts = nan_to_null(df, cols).agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols]).first()
    return [c for c in cols if counts[c] < counts["_n"]]


def missing_indicator(df: DataFrame, fitted: Sequence[str], cols: Sequence[str], error_on_new: bool = True,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Flags for the fitted columns; a column missing at transform time but
    not at fit time raises when ``error_on_new``."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    if error_on_new:
        new = [c for c in fitted_new(df, fitted, cols)]
        if new:
            raise ValueError(f"columns without missing values at fit time now have some: {new}")
    return df.select(*keep, *[(missing(c) if c in floating else F.col(c).isNull()).alias(f"{c}_missing") for c in fitted])


def fitted_new(df: DataFrame, fitted: Sequence[str], cols: Sequence[str]) -> list[str]:
    others = [c for c in cols if c not in fitted]
    if not others:
        return []
    counts = nan_to_null(df, others).agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in others]).first()
    return [c for c in others if counts[c] < counts["_n"]]


# -- discretizers -------------------------------------------------------------

def uniform_edges(df: DataFrame, c: str, n_bins: int) -> list[float]:
    """Equal-width edges between min and max; a constant column gets one bin."""
    lo, hi = df.agg(F.min(c), F.max(c)).first()
    if lo == hi:
        return [-math.inf, math.inf]
    step = (hi - lo) / n_bins
    return [lo + i * step for i in range(n_bins)] + [hi]


def _merge_close(edges: list[float]) -> list[float]:
    """Drop edges closer than 1e-8 to the previous kept one."""
    out = [edges[0]]
    for e in edges[1:]:
        if e - out[-1] > 1e-8:
            out.append(e)
    return out


def quantile_edges(df: DataFrame, c: str, n_bins: int) -> list[float]:
    """Linear percentiles at 0, 100/n, ..., 100; tiny bins merged."""
    qs = [i / n_bins for i in range(n_bins + 1)]
    rows = quantiles(df, c, qs, interpolation="linear").collect()
    by_q = {r["q"]: r["value"] for r in rows}
    return _merge_close([by_q[float(q)] for q in qs])


def weighted_percentiles(df: DataFrame, c: str, w: str, ps: Sequence[float]) -> DataFrame:
    """For each p (0..100): the first value (in sorted order) whose
    cumulative weight reaches p/100 of the total weight."""
    sums = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.sum(w).alias("_w"))
    cum = ordered_scan(sums, [F.col(c).asc()], [], [CumSum("_w", "_cw")])
    total = cum.agg(F.max("_cw")).first()[0]
    hits = cum.agg(*[F.min(F.when(F.col("_cw") >= F.lit(float(p) / 100.0 * total), F.col(c))).alias(f"_{i}") for i, p in enumerate(ps)])
    each = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col(f"_{i}").alias("value")) for i, p in enumerate(ps)]))
    return hits.select(each.alias("e")).select("e.*").where("value is not null")


def weighted_quantile_edges(df: DataFrame, c: str, w: str, n_bins: int) -> list[float]:
    ps = [100.0 * i / n_bins for i in range(n_bins + 1)]
    rows = {r["p"]: r["value"] for r in weighted_percentiles(df, c, w, ps).collect()}
    mx = df.agg(F.max(c)).first()[0]
    return _merge_close([rows.get(float(p), mx) for p in ps])


def kmeans_edges(df: DataFrame, c: str, n_bins: int, max_iter: int = 300, tol: float = 1e-4) -> list[float]:
    """1-D k-means from uniform centres (deterministic); edges at midpoints
    of sorted centres plus min and max.  Each iteration is one grouped
    aggregate over the (cached) column."""
    lo, hi = df.agg(F.min(c), F.max(c)).first()
    if lo == hi:
        return [-math.inf, math.inf]
    uni = [lo + i * (hi - lo) / n_bins for i in range(n_bins + 1)]
    centers = [(uni[i] + uni[i + 1]) * 0.5 for i in range(n_bins)]
    x = df.select(F.col(c).alias("x")).where("x IS NOT NULL").cache()
    try:
        for _ in range(max_iter):
            mids = [(centers[i] + centers[i + 1]) / 2 for i in range(len(centers) - 1)]
            b = sum((F.col("x") > F.lit(m)).cast("int") for m in mids) if mids else F.lit(0)
            new = dict(x.groupBy(b.alias("b")).agg(F.avg("x")).collect())
            moved = [new.get(i, centers[i]) for i in range(len(centers))]
            shift = sum((a - b2) ** 2 for a, b2 in zip(moved, centers))
            centers = moved
            if shift <= tol * tol * (hi - lo) ** 2:
                break
    finally:
        x.unpersist()
    centers.sort()
    return [lo] + [(centers[i] + centers[i + 1]) * 0.5 for i in range(len(centers) - 1)] + [hi]


def bin_index(c, edges: Sequence[float]) -> Column:
    """Ordinal bin: number of inner edges <= x (right-sided search), as a double."""
    col = F.col(c) if isinstance(c, str) else c
    inner = list(edges[1:-1])
    if not inner:
        return F.when(col.isNotNull(), F.lit(0.0))
    return sum((col >= F.lit(e)).cast("int") for e in inner).cast("double")


def kbins_transform(df: DataFrame, edges: dict[str, list[float]], encode: str = "ordinal") -> DataFrame:
    """ordinal: bin number per column; onehot(-dense): one 0/1 column per bin."""
    if encode == "ordinal":
        return df.withColumns({c: bin_index(c, e) for c, e in edges.items()})
    out = df
    for c, e in edges.items():
        b = bin_index(c, e)
        out = out.withColumns({f"{c}_{i}": (b == F.lit(float(i))).cast("double") for i in range(len(e) - 1)}).drop(c)
    return out


def kbins_inverse(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Bin number to the centre of the bin."""
    out = {}
    for c, e in edges.items():
        centres = [(e[i] + e[i + 1]) * 0.5 for i in range(len(e) - 1)]
        out[c] = F.element_at(F.array(*[F.lit(x) for x in centres]), F.col(c).cast("int") + 1)
    return df.withColumns(out)


# -- text ---------------------------------------------------------------------

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def term_counts(docs: DataFrame, doc: str = "doc_id", text: str = "text", lowercase: bool = True, ngram_range=(1, 1),
                analyzer: str = "word", stop_words: Sequence[str] = ()) -> DataFrame:
    """(doc, term, tf).  ``word``: tokens of two or more word characters without ``stop_words``, and runs of
    ``ngram_range`` consecutive tokens joined by a blank; ``char`` and ``char_wb``: character n-grams."""
    if analyzer != "word":
        return char_ngrams(docs, ngram_range, analyzer, doc, text).select(doc, F.col("ngram").alias("term"), F.col("count").alias("tf"))
    t = F.lower(text) if lowercase else F.col(text)
    words = F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 0)
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(list(stop_words)))
    lo, hi = ngram_range
    if (lo, hi) == (1, 1):
        grams = words
    else:
        docs, words = docs.withColumn("_words", words), F.col("_words")

        def joined(n):
            return lambda i: F.array_join(F.slice(words, i, n), " ")

        runs = [F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), joined(n)))
                .otherwise(F.array().cast("array<string>")) for n in range(lo, hi + 1)]
        grams = F.flatten(F.array(*runs))
    toks = docs.select(doc, F.explode(grams).alias("term"))
    return toks.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_df=1, max_df=1.0, max_features=None,
          binary: bool = False, norm: str | None = "l2", use_idf: bool = True, smooth_idf: bool = True,
          sublinear_tf: bool = False, ngram_range=(1, 1), analyzer: str = "word", stop_words: Sequence[str] = ()) -> DataFrame:
    """TF-IDF in long form (doc, term, tfidf); terms as in ``term_counts``.  df cut-offs (ints = document
    counts, floats = fractions), optional vocabulary cap by total count,
    smoothed idf ln((1+n)/(1+df))+1, and l1/l2 row norms."""
    tc = materialize(term_counts(docs, doc, text, True, ngram_range, analyzer, stop_words), "terms")  # read by the frequencies, the weights and the norms
    n_docs = docs.select(doc).distinct().count()
    dfreq = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    lo = min_df if isinstance(min_df, int) else math.ceil(min_df * n_docs)
    hi = max_df if isinstance(max_df, int) else math.floor(max_df * n_docs)
    vocab = dfreq.where((F.col("df") >= lo) & (F.col("df") <= hi))
    if max_features:
        vocab = vocab.orderBy(F.col("total").desc(), F.col("term")).limit(max_features)
    if use_idf:
        idf = (F.log((F.lit(1 + n_docs) / (1 + F.col("df")))) + 1) if smooth_idf else (F.log(F.lit(n_docs) / F.col("df")) + 1)
    else:
        idf = F.lit(1.0)
    vocab = vocab.select("term", idf.alias("idf"))
    tf = F.lit(1.0) if binary else (F.log(F.col("tf")) + 1 if sublinear_tf else F.col("tf").cast("double"))
    w = tc.join(vocab, "term").select(doc, "term", (tf * F.col("idf")).alias("w"))
    if norm is None:
        return w.withColumnRenamed("w", "tfidf")
    of = Window.partitionBy(doc)  # the terms of one document; one shuffle of the weights, which are computed once
    nrm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(of)) if norm == "l2" else F.sum(F.abs("w")).over(of)
    return w.where(F.col(doc).isNotNull()).withColumn("_norm", nrm).select(doc, "term", (F.col("w") / F.col("_norm")).alias("tfidf"))


def _substr_of(col: str, n: int):
    """One-argument lambda for ``transform`` (a two-argument lambda would be
    read as (element, index))."""
    return lambda i: F.substring(col, i, F.lit(n))


def char_ngrams(docs: DataFrame, ngram_range=(2, 3), analyzer: str = "char_wb", doc: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(doc, ngram, count).  ``char``: n-grams of the whitespace-normalized
    lower-cased text.  ``char_wb``: n-grams inside each word padded with one
    space on both sides; a padded word no longer than n yields itself once
    and stops the longer sizes."""
    lo, hi = ngram_range
    t = F.lower(text)
    docs = docs.select(doc, text)
    if analyzer == "char":
        s = docs.select(doc, F.regexp_replace(t, r"\s\s+", " ").alias("_s"))
        grams = []
        for n in range(lo, hi + 1):
            grams.append(F.transform(F.sequence(F.lit(1), F.greatest(F.length("_s") - n + 1, F.lit(0))),
                                     _substr_of("_s", n)))
        g = s.select(doc, F.explode(F.filter(F.flatten(F.array(*grams)), lambda x: F.length(x) > 0)).alias("ngram"))
    else:
        words = docs.select(doc, F.explode(F.split(F.trim(t), r"\s+")).alias("_w")).where(F.length("_w") > 0) \
            .select(doc, F.concat(F.lit(" "), F.col("_w"), F.lit(" ")).alias("_w"))
        L = F.length("_w")
        grams = []
        for n in range(lo, hi + 1):
            full = F.transform(F.sequence(F.lit(1), F.greatest(L - n + 1, F.lit(1))), _substr_of("_w", n))
            if n == lo:
                grams.append(full)  # a short word yields itself once
            else:
                grams.append(F.when(L >= n, full).otherwise(F.array().cast("array<string>")))
        g = words.select(doc, F.explode(F.flatten(F.array(*grams))).alias("ngram"))
    return g.groupBy(doc, "ngram").agg(F.count(F.lit(1)).alias("count"))
