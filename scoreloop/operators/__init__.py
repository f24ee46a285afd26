"""Relational operators over DataFrames: gates, checks, joins, windows, folds."""
