"""DataFrame operators: cleaning, lineage, duplicates, quality, keyed upserts."""
