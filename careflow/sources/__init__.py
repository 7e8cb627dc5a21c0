from careflow.sources.changelog import (
    decode_envelope,
    decode_fact,
    drop_tombstones,
    in_order,
    land_ods,
    land_topic,
    read_landed,
    read_ods,
    read_topic,
    record_order,
    rejected,
)
from careflow.sources.config import decode_config, read_landed_config, read_routes

__all__ = [
    "decode_config",
    "decode_envelope",
    "decode_fact",
    "drop_tombstones",
    "in_order",
    "land_ods",
    "land_topic",
    "read_landed",
    "read_landed_config",
    "read_ods",
    "read_routes",
    "read_topic",
    "record_order",
    "rejected",
]
