"""Funding-impact analytics as composable Spark DataFrame operators."""
