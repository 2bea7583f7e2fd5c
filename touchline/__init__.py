"""touchline: drawing-record, link-graph and match analytics as Spark DataFrame jobs."""

__all__ = ["schemas", "session"]
