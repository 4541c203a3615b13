"""Spark-first relational, spell and network analytics."""
