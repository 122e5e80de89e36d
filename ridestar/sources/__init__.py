"""Scans and sinks: CSV, Kafka, bronze Parquet archive, tables, test-data views."""
