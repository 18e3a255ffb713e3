"""Business jobs: DataFrames in, a DataFrame out, all dates from an explicit ``as_of``."""
