"""Row operators: projection, joins, deduplication, numbering, upsert."""
