"""Event-schema observability and data-contract validation on Spark.

Everything here maps DataFrames to DataFrames; the same stateless operators
serve batch tables and Structured Streaming input.
"""
