"""Siltstone: open-data analytics as composable Spark DataFrame operators."""
