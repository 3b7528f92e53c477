"""servstar — service-request star schema and KPIs on Spark.

Layers:

* ``sources``   — reading the given tables, binding them to the request/SLA/survey
                  source shapes, writers (parquet, CSV, JSON messages).
* ``functions`` — column expressions (rounding, calendar attributes, bands).
* ``operators`` — dimension and fact builders, data-quality checks, sized broadcast.
* ``plans``     — the warehouse (build + materialise), SQL and DataFrame KPIs,
                  dashboard datasets, the declared extract/validate/load flow.
* ``streaming`` — JSON event producer and the Structured Streaming consumer.
"""

from servstar.session import build_session, scratch_path, storage_root

__all__ = ["build_session", "scratch_path", "storage_root"]
