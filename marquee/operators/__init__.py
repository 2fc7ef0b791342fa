"""DataFrame operators: cleaning, star schema, documents, upserts, checks, snapshots."""
