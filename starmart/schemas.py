"""Table contracts: raw layouts, output columns and declared constraints.

Everything in this module is a fixed value. Raw files have no header and are
read by position, so the order of the fields matters as much as their types. Keys are
long: at a few hundred GB, order keys pass the range of an integer.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LONG, INT, DOUBLE = LongType(), IntegerType(), DoubleType()
STRING, TIMESTAMP = StringType(), TimestampType()

TABLES = (
    "customer",
    "supplier",
    "nation",
    "region",
    "part",
    "partsupp",
    "orders",
    "lineitem",
)
STAR_TABLES = ("fact_sales", "dim_customer", "dim_supplier", "dim_part")

_LINEITEM_TAIL = [
    ("l_linenumber", LONG),
    ("l_quantity", INT),
    ("l_extendedprice", DOUBLE),
    ("l_discount", DOUBLE),
    ("l_tax", DOUBLE),
    ("l_returnflag", STRING),
    ("l_linestatus", STRING),
    ("l_shipdate", TIMESTAMP),
    ("l_commitdate", TIMESTAMP),
    ("l_receiptdate", TIMESTAMP),
    ("l_shipinstruct", STRING),
    ("l_shipmode", STRING),
    ("l_comment", STRING),
]

_RAW_FIELDS = {
    "customer": [
        ("c_custkey", LONG),
        ("c_name", STRING),
        ("c_address", STRING),
        ("c_nationkey", LONG),
        ("c_phone", STRING),
        ("c_acctbal", DOUBLE),
        ("c_mktsegment", STRING),
        ("c_comment", STRING),
    ],
    "supplier": [
        ("s_suppkey", LONG),
        ("s_name", STRING),
        ("s_address", STRING),
        ("s_nationkey", LONG),
        ("s_phone", STRING),
        ("s_acctbal", DOUBLE),
        ("s_comment", STRING),
    ],
    "nation": [
        ("n_nationkey", LONG),
        ("n_name", STRING),
        ("n_regionkey", LONG),
        ("n_comment", STRING),
    ],
    "region": [("r_regionkey", LONG), ("r_name", STRING), ("r_comment", STRING)],
    "part": [
        ("p_partkey", LONG),
        ("p_name", STRING),
        ("p_mfgr", STRING),
        ("p_brand", STRING),
        ("p_type", STRING),
        ("p_size", INT),
        ("p_container", STRING),
        ("p_retailprice", DOUBLE),
        ("p_comment", STRING),
    ],
    "partsupp": [
        ("ps_partkey", LONG),
        ("ps_suppkey", LONG),
        ("ps_availqty", INT),
        ("ps_supplycost", DOUBLE),
        ("ps_comment", STRING),
    ],
    "orders": [
        ("o_orderkey", LONG),
        ("o_custkey", LONG),
        ("o_orderstatus", STRING),
        ("o_totalprice", DOUBLE),
        ("o_orderdate", TIMESTAMP),
        ("o_orderpriority", STRING),
        ("o_clerk", STRING),
        ("o_shippriority", INT),
        ("o_comment", STRING),
    ],
}

# The first three line-item fields have two readings. "stock" is the order of the
# public benchmark generator; "named" is for files that carry a line id first.
LINEITEM_LAYOUTS = {
    "stock": [("l_orderkey", LONG), ("l_partkey", LONG), ("l_suppkey", LONG), *_LINEITEM_TAIL],
    "named": [("l_id", LONG), ("l_orderkey", LONG), ("l_ps_id", LONG), *_LINEITEM_TAIL],
}

# Every raw line ends in the separator, which reads as one more, always empty field.
TRAILING_FIELD = "trailing_unnamed"


def raw_schema(table: str, layout: str = "stock") -> StructType:
    """Fields of a raw table by position, without the trailing empty one."""
    fields = LINEITEM_LAYOUTS[layout] if table == "lineitem" else _RAW_FIELDS[table]
    return StructType([StructField(name, kind, True) for name, kind in fields])


def with_trailing_field(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(TRAILING_FIELD, DoubleType(), True)])


# The partition columns of stored tables, whose types folder names do not tell.
PARTITION_TYPES = {"s_year": INT}

CLEAN_COLUMNS = {
    "customer": [
        "c_custkey",
        "c_name",
        "c_address",
        "c_nationkey",
        "c_phone",
        "c_acctbal",
        "c_acctbal_class",
        "c_mktsegment",
        "c_comment",
    ],
    "supplier": [
        "s_suppkey",
        "s_name",
        "s_address",
        "s_nationkey",
        "s_phone",
        "s_acctbal",
        "s_comment",
    ],
    "nation": [
        "n_nationkey",
        "n_name",
        "n_regionkey",
        "n_comment",
    ],
    "region": [
        "r_regionkey",
        "r_name",
        "r_comment",
    ],
    "part": [
        "p_partkey",
        "p_name",
        "p_mfgr",
        "p_brand",
        "p_type",
        "p_size",
        "p_container",
        "p_retailprice",
        "p_comment",
    ],
    "partsupp": [
        "ps_id",
        "ps_partkey",
        "ps_suppkey",
        "ps_availqty",
        "ps_supplycost",
        "ps_comment",
    ],
    "orders": [
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_year",
        "o_month",
        "o_orderpriority",
        "o_clerk",
        "o_shippriority",
        "o_comment",
    ],
    "lineitem": [
        "l_id",
        "l_orderkey",
        "l_ps_id",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_revenue",
        "l_returnflag",
        "l_linestatus",
        "l_commitdate",
        "l_shipdate",
        "l_receiptdate",
        "l_shipinstruct",
        "l_shipmode",
        "l_comment",
    ],
}

STAR_COLUMNS = {
    "fact_sales": [
        "s_orderkey_linenumber",
        "s_orderkey",
        "s_custkey",
        "s_suppkey",
        "s_orderstatus",
        "s_totalprice",
        "s_orderdate",
        "s_year",
        "s_month",
        "s_orderpriority",
        "s_clerk",
        "s_shippriority",
        "s_o_comment",
        "s_id",
        "s_linenumber",
        "s_quantity",
        "s_extendedprice",
        "s_discount",
        "s_tax",
        "s_revenue",
        "s_returnflag",
        "s_linestatus",
        "s_commitdate",
        "s_shipdate",
        "s_receiptdate",
        "s_shipinstruct",
        "s_shipmode",
        "s_l_comment",
    ],
    "dim_customer": [
        "c_custkey",
        "c_name",
        "c_address",
        "c_phone",
        "c_acctbal",
        "c_mktsegment",
        "c_comment",
        "c_nationkey",
        "c_n_name",
        "c_n_comment",
        "c_regionkey",
        "c_r_name",
        "c_r_comment",
    ],
    "dim_supplier": [
        "supp_suppkey",
        "supp_name",
        "supp_address",
        "supp_phone",
        "supp_acctbal",
        "supp_comment",
        "supp_nationkey",
        "supp_n_name",
        "supp_n_comment",
        "supp_regionkey",
        "supp_r_name",
        "supp_r_comment",
    ],
    "dim_part": [
        "p_partkey_suppkey",
        "p_partkey",
        "p_name",
        "p_mfgr",
        "p_brand",
        "p_type",
        "p_size",
        "p_container",
        "p_retailprice",
        "p_comment",
        "ps_suppkey",
        "ps_availqty",
        "ps_supplycost",
        "ps_comment",
    ],
}

# Declared constraints. Only the two comments below may be NULL.
NULLABLE = {"n_comment", "r_comment"}

NOT_NULL = {
    table: [name for name in raw_schema(table).names if name not in NULLABLE]
    for table in TABLES
}

PRIMARY_KEYS = {
    "nation": ["n_nationkey"],
    "region": ["r_regionkey"],
    "part": ["p_partkey"],
    "supplier": ["s_suppkey"],
    "partsupp": ["ps_partkey", "ps_suppkey"],
    "customer": ["c_custkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
}

# (child table, child columns, parent table, parent columns)
FOREIGN_KEYS = (
    ("nation", ["n_regionkey"], "region", ["r_regionkey"]),
    ("supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("partsupp", ["ps_suppkey"], "supplier", ["s_suppkey"]),
    ("partsupp", ["ps_partkey"], "part", ["p_partkey"]),
    ("customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    (
        "lineitem",
        ["l_partkey", "l_suppkey"],
        "partsupp",
        ["ps_partkey", "ps_suppkey"],
    ),
)
