"""Spark operators for a register of dated property certificates."""
