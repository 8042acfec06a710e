"""loamflow: incremental landing-zone ingestion and its analysis, on plain Apache Spark.

Layout
------
- ``sources``   landing listing, named-file landing writer, raw and results datasets
- ``functions`` column expressions (names, epochs, messages) and schema tracking / rescue
- ``operators`` ownership join, sharding, topic checks, statistics, makespan, restart verdict
- ``streaming`` evolving ingest, multi-collection drain, count-only measurement
- ``plans``     the resolve plan and the driver-contract queries
"""

__version__ = "0.1.0"
