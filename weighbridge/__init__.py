"""Spark jobs that ingest scale measurement files and report on them."""
