"""Scans and sinks: parquet tables, adapter views, CSV import/export, feature history."""
