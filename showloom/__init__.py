"""Catalogue analytics on PySpark: key diffs, page extraction, cleaning, incremental ingest."""
