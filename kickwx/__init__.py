"""kickwx: football match outcomes against kick-off weather, as Spark DataFrame jobs.

Layers: ``sources`` (bronze readers and schemas), ``functions`` (column
expressions: keys, casts, buckets, masks), ``operators`` (dedup, as-of weather
selection, upsert, enrichment, quality checks), ``plans`` (staging models,
marts, analytical queries), ``streaming`` (incremental payload ingest).
"""

__all__ = ["session"]
