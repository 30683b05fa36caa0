"""DataFrame operators: extraction, cleansing, latest-per-key, retention, seed."""
