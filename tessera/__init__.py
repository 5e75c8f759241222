"""Training-data analytics on Spark: functions, operators, plans, sources and streams."""
