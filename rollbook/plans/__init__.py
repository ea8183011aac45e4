"""Models: plain functions from DataFrames to a DataFrame, and the jobs that write them."""
