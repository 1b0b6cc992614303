"""DataFrame -> DataFrame operators: wide table, changes, lookups, aggregations, user code."""
