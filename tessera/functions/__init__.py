"""Column functions (JVM side unless a name ends in _udf)."""
