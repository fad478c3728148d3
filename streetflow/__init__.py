"""Road-traffic analytics as composable Spark DataFrame operators."""
