from careflow.operators.first import first_flag, first_row
from careflow.operators.joins import interval_join, ttl_join
from careflow.operators.lookup import hot_keys, lookup, lookup_hot
from careflow.operators.routing import latest_routes, prune, route, route_versions, table_lifecycle
from careflow.operators.upsert import apply_changes, deleted_keys
from careflow.operators.windows import tumbling, with_bounds

__all__ = [
    "apply_changes",
    "deleted_keys",
    "first_flag",
    "first_row",
    "hot_keys",
    "interval_join",
    "latest_routes",
    "lookup",
    "lookup_hot",
    "prune",
    "route",
    "route_versions",
    "table_lifecycle",
    "ttl_join",
    "tumbling",
    "with_bounds",
]
