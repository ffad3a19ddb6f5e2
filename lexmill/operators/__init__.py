"""DataFrame operators: joins, aggregations, ordered computations and upserts."""
