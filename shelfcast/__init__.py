"""shelfcast: retail demand analytics expressed as Spark DataFrame plans.

Layers:
  sources/    table scans, sinks and the fixture adapter that derives retail tables
  functions/  reusable column expressions (dates, hashing draws, metrics, prefix sums, KS)
  operators/  cleaning, reshape/joins, features, exploration, forecasting, drift, ordering
  plans/      the registered query catalog and the matching DuckDB oracle SQL
  streaming/  the keyed stateful drift monitor on Structured Streaming
"""

__all__ = ["session"]
