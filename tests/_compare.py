"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


def assert_same(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame):
    c1, r1 = rows(spark_pdf)
    c2, r2 = rows(duck_pdf)
    assert c1 == c2, f"columns differ: {c1} vs {c2}"
    assert len(r1) == len(r2), f"row counts differ: {len(r1)} vs {len(r2)}"
    assert r1 == r2, f"values differ, e.g. {sorted(set(r1) - set(r2), key=repr)[:3]} vs {sorted(set(r2) - set(r1), key=repr)[:3]}"
