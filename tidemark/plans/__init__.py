"""Domain views over the supplied tables, and the registered queries with their check SQL."""
