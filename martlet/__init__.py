"""martlet: a sales mart (staging -> silver -> gold) built as PySpark DataFrame jobs.

Layout
------
sources/    raw read schemas, NDJSON landing and bronze split, driver-table fixtures
functions/  column expressions (safe casts, merge key, order measures)
operators/  reusable DataFrame operators (latest-row de-dup, keyed upsert,
            extraction audit, distributed running sum)
plans/      the model jobs (staging, silver, gold, analyses) and the refresh jobs
streaming/  incremental landing with a file-source stream + foreachBatch
"""

__version__ = "0.1.0"
