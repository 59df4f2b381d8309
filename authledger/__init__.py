"""Prior-authorization and claims analytics as plain Spark DataFrame code."""
