"""Cell-network analytics as plain Spark jobs."""
