"""Load pipeline and named analytics queries."""
