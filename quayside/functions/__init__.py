"""Column functions and the few statistical distribution functions Spark has no expression for."""
