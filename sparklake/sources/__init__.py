"""Scans: landing CSV, Parquet layers, JSON payloads, fixed dimensions."""
