"""Table operators: batching, syncs, reports, records, mapping, sitemaps, spines."""
