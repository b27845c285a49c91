"""Plan shapes shared by several operators: ordered blocks, exact quantiles, category levels."""
