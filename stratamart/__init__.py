"""Layered order analytics on Spark: staging, joins, star schema, history, checks."""
