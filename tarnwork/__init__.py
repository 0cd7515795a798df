"""Spark-first analytics engine for vulnerability intelligence data."""
