"""Analytics operators: DataFrame in, DataFrame out, always lazy."""
