"""triplake: trip-history lakehouse (raw -> staging -> marts) on the public Spark DataFrame API.

Sub-packages:
  sources    scans, sinks, period discovery, the test-table adapter
  functions  Column-level helpers (safe casts, code maps, date parts, rounding)
  operators  DataFrame -> DataFrame operators (normalise, rules, dedup, marts, profiles, measures)
  plans      multi-step jobs (clean raw periods, rebuild and incremental marts)
  streaming  Structured Streaming arrival of new raw files
"""

__version__ = "0.1.0"
