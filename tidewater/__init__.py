"""tidewater: operational-document analytics written as Spark DataFrame jobs.

Layers
------
sources/    landed files -> bronze rows (key, data, extracted_at)
sinks/      upsert, de-duplication, soft delete, dead letters, exports
functions/  Column builders: JSON paths, typed casts, arrays, code maps, dates
operators/  DataFrame -> DataFrame building blocks: joins, marts, windows, filters
plans/      silver and gold views over the bronze tables, named audit queries,
            and the stand-in queries that run the operators on the driver tables
streaming/  file-stream ingest (readStream -> foreachBatch upsert, availableNow)
"""

__version__ = "0.1.0"
