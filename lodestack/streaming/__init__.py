"""Structured Streaming: logs, queues and budgets as unbounded tables."""
