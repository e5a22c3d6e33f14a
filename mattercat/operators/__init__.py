"""Relational operators: edits, joins, aggregates, order and sets."""
