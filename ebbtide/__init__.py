"""Daily short-position analytics written as Spark DataFrame plans."""
