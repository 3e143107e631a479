"""Aspect-based review analytics on Spark: ingest, decode, train, score, measure."""
