from careflow.sinks.dimensions import DimensionStore
from careflow.sinks.runs import in_batches, query_id
from careflow.sinks.tables import json_rows, read_summary, write_summary, write_topic

__all__ = ["DimensionStore", "in_batches", "json_rows", "query_id", "read_summary", "write_summary", "write_topic"]
