"""Marketing attribution as Spark DataFrame functions."""
