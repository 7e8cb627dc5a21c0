"""Fixed outer schemas of the change log, the routing table and the detail facts."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# Envelope of one row change: where it happened, what kind it is, the row now, the fields as before.
ENVELOPE = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("data", TEXT_MAP),
        T.StructField("old", TEXT_MAP),
    ]
)

# Change kinds that carry no row.
CONTROL_TYPES = ("bootstrap-start", "bootstrap-complete")

# Routing table: which source table feeds which dimension, with which columns and row key.
ROUTE_COLUMNS = ("source_table", "sink_table", "sink_family", "sink_columns", "sink_row_key")
ROUTE_COLUMNS_CAMEL = ("sourceTable", "sinkTable", "sinkFamily", "sinkColumns", "sinkRowKey")

ROUTE = T.StructType([T.StructField(name, T.StringType()) for name in ROUTE_COLUMNS])

# Status codes of consultations and prescriptions.
PAID = "203"
REVIEWED = "207"

# Highest rating; a review with it is a good one.
GOOD_RATING = 5

MONEY = T.DecimalType(16, 2)

# Order of changes: wide enough for time, partition and offset of a record.
ORDER = T.DecimalType(38, 0)


def texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])
