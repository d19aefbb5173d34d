"""Support-conversation analytics as Spark jobs."""

__all__ = ["values", "functions", "operators", "sources", "plans", "streaming"]
