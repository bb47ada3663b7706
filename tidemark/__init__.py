"""tidemark: a Spark-native change-data pipeline library.

Change records -> bronze change log -> silver latest state -> SCD2 history ->
gold dimensions, as-of fact and reporting, with constraint checks; written with
the DataFrame API and Structured Streaming only.
"""

__version__ = "0.1.0"
