"""Set-wise operators: each takes DataFrames and returns a DataFrame."""
