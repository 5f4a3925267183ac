"""Complete plans: the roster views of the given tables, the registered queries, the daily run."""
