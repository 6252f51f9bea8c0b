"""Readers (pages, dictionaries, seeds) and sinks (CSV, Parquet, JDBC)."""
