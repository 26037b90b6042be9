"""Tidemark: contract checks, expectations, reshaping and incremental layers on Spark."""
