"""salesmart — a Spark-native retail sales-mart pipeline.

Landed sales CSVs are audited against the mandatory header, folded into one
fixed-schema fact, enriched with customer / store / sales-team / product
dimensions and turned into customer and sales-team marts.  Every step is a
``DataFrame -> DataFrame`` transformation; actions live in ``sinks`` and
``plans.pipeline``.
"""

__version__ = "0.1.0"
