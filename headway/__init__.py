"""headway: GTFS static-schedule analytics on Spark.

Every model is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; Catalyst and AQE pick the physical plan.

Layout
------
functions/   Column-level helpers (time parsing, surrogate keys, decoders,
             guarded sequences, service-day overflow).
sources/     Feed readers (CSV folders, zip archives), snapshot archive and
             replay, registry loader, and the test-table bridge.
operators/   Staging, calendar, dimensions, facts, presentation marts,
             analyses, data-quality checks, and the join helpers they share.
plans/       The model graph: build every model in dependency order and
             write the marts.
streaming/   Incremental pick-up of newly landed feed archives.
"""

__version__ = "0.1.0"
