"""Plans over DataFrames: joins, windows, aggregates and the composite market operators."""
