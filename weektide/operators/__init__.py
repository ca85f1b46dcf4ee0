"""DataFrame in, DataFrame out: lazy operators over the transactions table."""
