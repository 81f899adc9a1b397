"""Typed readers and raw batches."""
