"""The user-facing reports, each a function from DataFrames to a DataFrame."""
