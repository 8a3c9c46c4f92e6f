"""Medallion-style batch analytics on Spark: landing, raw, curated, control."""
