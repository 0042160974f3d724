"""Dataset-level operators: key joins, duplicate groups, aggregates, metrics, samples."""
