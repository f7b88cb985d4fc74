"""DataFrame steps: extract, join, flatten, dedup, sort, enumerate, summarize."""
