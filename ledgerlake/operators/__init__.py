"""Dataset operators: batches, deduplication, joins, keys, history, quality."""
