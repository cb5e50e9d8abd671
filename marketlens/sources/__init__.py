"""Readers and writers: documents, tables, JDBC and versioned Parquet."""
