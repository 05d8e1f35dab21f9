"""Analytics and forecasting of metered electricity use and cost, as Spark jobs."""
