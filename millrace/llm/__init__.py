"""Operators for training data: each is registered as a query in ``millrace.llm.queries``."""
