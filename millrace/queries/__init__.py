"""Every operator as a query on the benchmark tables, with its SQL counterpart."""

from millrace.queries.registry import oracles, registered

__all__ = ["oracles", "registered"]
