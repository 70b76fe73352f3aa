"""The models: staging, joins, star schema, history, checks and the layered build."""
