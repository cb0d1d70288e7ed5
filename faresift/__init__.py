"""faresift: quality checks, cleaning and profiling of metered-trip data on Spark."""
