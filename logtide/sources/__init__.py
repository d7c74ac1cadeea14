"""Readers: event logs, parquet tables, line files, incremental and blob sources."""
