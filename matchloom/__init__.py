"""Match and price analytics as Spark DataFrame jobs."""
