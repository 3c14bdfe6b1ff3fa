"""Trip telemetry analytics on Spark: DataFrame, Structured Streaming and MLlib operators."""
