"""DataFrame operators: every one maps DataFrames to DataFrames and runs nothing itself."""
