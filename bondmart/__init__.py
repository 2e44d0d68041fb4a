"""Bond-market reporting on Spark."""
