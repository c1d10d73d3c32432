"""Retail demand analytics as composable Spark DataFrame operators."""
