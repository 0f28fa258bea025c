"""tripmart: a Spark-native trip ingestion, load, transformation and mart engine.

Layout:
  sources/    scans, seeds, by-name loads with a bad-file report, sinks
  functions/  column expressions (duration, speed, surrogate key, ...)
  operators/  filters, projections, dedup, upsert, aggregates, joins, checks
  plans/      per-service ingest, load, staging, union, fact, marts, suites
  streaming/  the incremental fact load as a Structured Streaming job
"""

from tripmart.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
