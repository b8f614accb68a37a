"""Connected-vehicle trip analytics built from Spark DataFrame operations."""
