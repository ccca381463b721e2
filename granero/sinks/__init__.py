"""Writing: target layouts, Parquet mart, databases, text dumps."""
