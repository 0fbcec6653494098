"""Tables and marts. Each is a function from DataFrames to a DataFrame."""
