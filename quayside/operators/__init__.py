"""The operators, by kind of work."""
