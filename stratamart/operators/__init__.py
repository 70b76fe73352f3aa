"""Reusable DataFrame operators: storage, joins, merge, history, checks."""
