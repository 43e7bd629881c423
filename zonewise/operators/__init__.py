"""DataFrame transformations built from joins, aggregations and windows."""
