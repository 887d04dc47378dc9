"""Speech analytics and corpus processing on Spark."""
