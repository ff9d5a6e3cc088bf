"""Ingestion of files as they arrive."""
