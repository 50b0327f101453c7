"""See README.md for the map of operators to modules."""
