"""strata: a PySpark library of medallion-pipeline operators for social
activity data (ingest, quality, text, reports), built on DataFrames."""

__version__ = "0.1.0"
