"""DataFrame -> DataFrame operators: dedup, keys, lookups, Silver, dims, SCD2, facts, windows."""
