"""Spark-first ingestion: raw text feeds to typed, validated, routed tables."""
