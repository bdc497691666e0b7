"""stationdw: a Spark-native warehouse for station-by-date climate normals.

Layers
------
sources    readers for header CSV files and JSON message streams (batch or streaming)
functions  column expressions: numeric / date conversions, unit changes, seasons, JSON fields
operators  DataFrame operators: cleaning and quarantine, keep-latest upserts, surrogate keys,
           aggregates, ranks, constraint checks, size-checked joins
plans      composed jobs: star-schema load, daily / monthly views, the five OLAP reports and
           the mapping from the driver's TPC-H-like tables onto the climate model
streaming  Structured Streaming jobs: clean stream, continuous monthly summary, staging upsert

Every operator takes column names as arguments, so it runs on any table with the same shape.
"""

from stationdw.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
