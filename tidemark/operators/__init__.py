"""Dedupe, keys, joins, growth, standings, roll-ups and series aggregation."""
