"""adlake: ad analytics and feature-store jobs on Spark DataFrames.

Subpackages
-----------
sources    table views, feature-snapshot store, decision log
functions  Column -> Column helpers (dates, day part, Wilson, arm hash, ...)
operators  batch feature jobs, as-of joins, quality gate, resolution,
           models, decisions, reports
streaming  Structured Streaming versions of the session features
plans      the named-query catalog and its SQL oracle
"""

__all__ = ["session", "config"]
