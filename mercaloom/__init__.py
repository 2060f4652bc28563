"""Retail star-schema jobs on Spark: raw tables in, checked star schema out."""
