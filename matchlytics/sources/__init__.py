from matchlytics.sources.raw import MissingSource, read_raw
from matchlytics.sources.schemas import EVENTS, LINEUPS, MATCHES, RAW
from matchlytics.sources.tables import append, clear_partitions, read_table, replace_partitions, replace_table, table_exists

__all__ = [
    "EVENTS",
    "LINEUPS",
    "MATCHES",
    "RAW",
    "MissingSource",
    "append",
    "clear_partitions",
    "read_raw",
    "read_table",
    "replace_partitions",
    "replace_table",
    "table_exists",
]
