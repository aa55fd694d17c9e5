"""Commerce event warehouse on Spark: detail facts, visitor logic and window reports as DataFrame functions."""
