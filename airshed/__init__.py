"""Station-level environmental time series and regional outcomes, on Spark."""
