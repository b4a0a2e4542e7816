"""Security-analytics operators as lazy Spark DataFrame transformations."""
