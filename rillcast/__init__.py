"""rillcast: sensor time-series analytics and forecasting as Spark DataFrame jobs."""
