from starmart.sources.catalog import (
    bucket_count,
    create_database,
    register_table,
    write_bucketed,
)
from starmart.sources.snapshots import expire, publish, read_published, register_published
from starmart.sources.tbl import (
    land_raw,
    read_raw,
    read_tbl,
    split_raw,
    tbl_path,
    write_tbl,
)
from starmart.sources.zones import read_zone, write_counted, write_zone

__all__ = [
    "bucket_count",
    "create_database",
    "expire",
    "land_raw",
    "publish",
    "read_published",
    "read_raw",
    "read_tbl",
    "read_zone",
    "register_published",
    "register_table",
    "split_raw",
    "tbl_path",
    "write_bucketed",
    "write_counted",
    "write_tbl",
    "write_zone",
]
