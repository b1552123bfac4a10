"""quarry: warehouse, sensitive-data, governance and alerting jobs on Spark.

Every operator takes and returns DataFrames; the heavy lifting is left to
Catalyst (pushdown, pruning, join selection) and AQE (coalescing, skew
splits, runtime broadcast conversion).
"""

from quarry.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
