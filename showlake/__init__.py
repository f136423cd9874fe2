"""Analytics of a subscription video service as Spark DataFrame operators."""
