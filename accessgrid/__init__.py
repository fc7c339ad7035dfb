"""Infrastructure-access analytics as Spark DataFrame functions."""
