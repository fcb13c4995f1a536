"""Training-data operators and their queries. Nothing else in the package imports this one."""
