"""Operators on DataFrames: filters, joins, de-duplication, checks, reports, repairs."""
