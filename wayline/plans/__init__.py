"""Models: staging, dimensions, facts, marts and served queries."""
