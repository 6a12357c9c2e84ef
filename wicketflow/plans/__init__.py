"""Jobs that chain operators, and the query catalogue."""
