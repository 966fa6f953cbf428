"""finspark: financial market data pipelines on Spark DataFrames.

Subpackages: ``functions`` (column expressions), ``operators`` (indicators,
ratios, enrichment, aggregation, quality rules), ``sources`` (files, landed
payloads, documents, JDBC), ``sinks`` (staging and keyed table writes),
``streaming`` (bounded drains) and ``plans`` (the daily job and the query
catalogue).
"""

__version__ = "0.1.0"
