"""carelens: operational analytics for communities, written as Spark DataFrame jobs.

Layers
------
sources/    batch readers and writers (feeds, reference data, exports)
streaming/  incremental ingest with Structured Streaming
functions/  column expressions (text, dates, numbers)
operators/  reusable DataFrame -> DataFrame building blocks
plans/      silver, gold, KPI views, measures, reports, validation, pipeline
workload/   the registered queries over the benchmark tables and their SQL oracles
"""

__version__ = "0.1.0"
