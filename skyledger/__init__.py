"""Layered table pipelines (raw files -> cleaned tables -> marts) as Spark DataFrame operators."""
