"""Analytics operators for entity time series and event tables, as functions from DataFrames to DataFrames."""
