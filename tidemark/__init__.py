"""Change-event analytics on Spark: decode, order, merge, keep and validate change data."""
