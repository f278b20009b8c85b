"""msgtriage: multi-label short-message triage as Spark DataFrame / Spark ML jobs.

Layout
------
- ``sources``   readers and writers (CSV, Parquet tables, word vectors, models)
- ``functions`` Column-expression builders (text cleaning, label parsing, vectors)
- ``operators`` DataFrame -> DataFrame operators (ingest, profiling, sampling,
                features, metrics, lexicon joins, similarity, models)
- ``plans``     end-to-end plans (ETL, training, dashboard) and the query catalog
- ``streaming`` Structured Streaming jobs (scoring, live counts, dedupe)
"""

__version__ = "0.1.0"
