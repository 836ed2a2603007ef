"""Transit transformations, metrics, data quality and the query catalog."""
