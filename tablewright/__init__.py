"""Supervised learning on tables, expressed as Spark DataFrame and MLlib jobs."""
