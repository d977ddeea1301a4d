"""The registered queries: travel-shaped inputs derived from the given tables, the queries, their oracles."""
