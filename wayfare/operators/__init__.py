"""DataFrame operators: projections, joins, aggregates, windows, sets."""
