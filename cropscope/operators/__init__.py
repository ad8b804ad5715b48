"""DataFrame -> DataFrame operators (aggregates, windows, joins, models)."""
