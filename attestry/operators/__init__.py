"""Set operators: DataFrames in, DataFrames out."""
