"""Analytics over machine telemetry on Spark DataFrames."""
