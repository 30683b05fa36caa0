"""wardline: admit/discharge/transfer message analytics on Spark.

Every operator is a plain function over DataFrames and Columns: HL7 v2 and
XML envelopes are parsed with native Spark expressions, fanned out to four
history tables, upserted into current-state tables, seeded from relational
tables and pruned by a retention rule.
"""

__version__ = "0.1.0"
