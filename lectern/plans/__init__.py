"""The domain, composed from operators: DataFrames in, DataFrames out."""
