"""Training-log analytics on Spark: sheet cells to bronze, bronze to star, star to metrics."""
