"""Training-data operators: thirteen corpus operators and their queries. Nothing else in the package imports this."""
