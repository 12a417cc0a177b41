"""nestgate: nested-record harvest, enrichment and data-quality checks on Spark.

Subpackages: ``sources`` (XML, JSON, Parquet, generator), ``operators``
(nest/unnest, lookup enrichment, set operations), ``functions`` (rule
builders, coercion), ``plans`` (validation runs, conformance, export,
profile, the collection model), ``streaming`` (incremental gate).
"""

__version__ = "0.1.0"
