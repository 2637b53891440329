"""colonnade: DataFrame operators, docstring-corpus jobs, statistics and
learners expressed as Spark jobs.

Every operator is a plain function ``f(df, ...) -> DataFrame``.  Functions
that depend on row order take an explicit ``order`` (a total order); the
library never relies on the physical order of rows.
"""

__all__ = ["session"]
