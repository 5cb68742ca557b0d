"""Jobs made of operators, and the query catalogue over the given tables."""
