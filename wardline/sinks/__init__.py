"""Table actions and sinks: staged overwrite, upsert, metered appends, warehouse copy."""
