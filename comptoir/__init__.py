"""comptoir — product & review analytics as Spark DataFrame jobs.

Subpackages:
  functions  Column -> Column expressions (prices, storage sizes, URLs, review text)
  sources    readers and writers (CSV, JSON, Parquet, binary listings, page corpora)
  operators  DataFrame -> DataFrame operators (clean, dedupe, joins, aggregates, extraction, text)
  plans      composite flows (price segmentation, dashboard, recommender, run statistics)
  streaming  Structured Streaming forms of the incremental flows
"""

__version__ = "0.1.0"
