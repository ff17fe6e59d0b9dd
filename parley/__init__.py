"""Team-chat analytics on Spark: pages to tables, batches to a master, tables to metrics."""

from parley.dialect import FLAT, THREADED, Dialect

__all__ = ["FLAT", "THREADED", "Dialect"]
