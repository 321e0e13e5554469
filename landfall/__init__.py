"""Landfall: metadata-driven batch ingestion expressed as Spark DataFrame plans."""
