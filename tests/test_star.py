import pytest
from pyspark.sql import functions as F

from conftest import bag, plan
from starmart.operators import contract, prefix_rename
from starmart.plans import clean, star
from starmart.schemas import CLEAN_COLUMNS, STAR_COLUMNS, TABLES, raw_schema


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def nation(spark):
    return frame(
        spark,
        [(0, "ALGERIA", 0, "n0"), (1, "PERU", 1, "n1"), (2, "NOWHERE", 9, None)],
        raw_schema("nation"),
    )


@pytest.fixture
def region(spark):
    return frame(
        spark, [(0, "AFRICA", "r0"), (1, "AMERICA", "r1"), (4, "MIDDLE", None)],
        raw_schema("region"),
    )


def test_contract_order_and_strictness(spark):
    df = frame(spark, [(1, 2, 3)], "c int, a int, x int")
    assert contract(df, ["a", "b", "c"]).columns == ["a", "c"]
    with pytest.raises(ValueError, match="b"):
        contract(df, ["a", "b", "c"], strict=True)


def test_prefix_rename_only_touches_the_start(spark):
    df = frame(spark, [(1, 2, 3)], "s_key int, key_s_x int, o_s_y int")
    assert prefix_rename(df, "s_", "supp_").columns == ["supp_key", "key_s_x", "o_s_y"]


@pytest.mark.parametrize("table", TABLES)
def test_clean_contract(spark, table):
    raw = spark.createDataFrame([], raw_schema(table))
    if table == "lineitem":
        raw = raw.withColumn("l_id", F.col("l_orderkey"))
    df = clean.BUILDERS[table](raw, strict=True)
    assert df.columns == CLEAN_COLUMNS[table]


def test_clean_partsupp_id(spark):
    rows = [(1, 5, 10, 2.5, "c")]
    df = clean.clean_partsupp(frame(spark, rows, raw_schema("partsupp")), strict=True)
    assert [tuple(r) for r in df.collect()] == [(5, 1, 5, 10, 2.5, "c")]


def test_fact_sales(spark):
    orders = clean.clean_orders(
        frame(
            spark,
            [
                (1, 100, "O", 10.0, None, "HIGH", "clerk", 0, "o1"),
                (2, 100, "O", 20.0, None, "LOW", "clerk", 0, "o2"),
                (None, 101, "F", 30.0, None, "LOW", "clerk", 0, "o3"),
            ],
            raw_schema("orders"),
        ),
        strict=True,
    )
    ts = "CAST(NULL AS TIMESTAMP)"
    lineitem = spark.sql(
        f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 5 AS l_quantity,
               10.0D AS l_extendedprice, 0.5D AS l_discount, 0.25D AS l_tax,
               'N' AS l_returnflag, 'O' AS l_linestatus, {ts} AS l_shipdate,
               {ts} AS l_commitdate, {ts} AS l_receiptdate, 'x' AS l_shipinstruct,
               'AIR' AS l_shipmode, 'l' AS l_comment, l_orderkey AS l_id
        FROM VALUES (1, 7, 70, 1L), (1, 7, 71, 2L), (3, 8, 72, 1L), (NULL, 8, 73, 1L)
             AS v(l_orderkey, l_partkey, l_suppkey, l_linenumber)
        """
    )
    lines = clean.clean_lineitem(lineitem, strict=True, with_partkey=True)
    fact = star.fact_sales(orders, lines, strict=True)
    assert fact.columns == STAR_COLUMNS["fact_sales"]
    got = fact.select(
        "s_orderkey_linenumber", "s_orderkey", "s_custkey", "s_suppkey", "s_revenue",
        "s_o_comment", "s_l_comment",
    )
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(
            str,
            [
                ("11", 1, 100, 70, 9.25, "o1", "l"),
                ("12", 1, 100, 71, 9.25, "o1", "l"),
                ("31", 3, None, 72, 9.25, None, "l"),
                (None, None, None, 73, 9.25, None, "l"),
                (None, 2, 100, None, None, "o2", None),
                (None, None, 101, None, None, "o3", None),
            ],
        )
    )
    with_part = star.fact_sales(orders, lines, with_partkey=True)
    assert with_part.columns == [*STAR_COLUMNS["fact_sales"], "s_partkey"]
    assert {r[0] for r in with_part.select("s_partkey").collect()} == {7, 8, None}


def test_geography(spark, nation, region):
    rows = star.geography(nation, region).select("nationkey", "regionkey", "r_name")
    assert bag(rows, ["nationkey", "regionkey", "r_name"]) == bag(
        spark.sql(
            "SELECT * FROM VALUES (0, 0, 'AFRICA'), (1, 1, 'AMERICA'), (2, 9, NULL), "
            "(NULL, 4, 'MIDDLE') AS v(nationkey, regionkey, r_name)"
        ),
        ["nationkey", "regionkey", "r_name"],
    )


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_dim_customer(spark, with_conf, nation, region, threshold):
    rows = [(1, "A", "adr", 0, "ph", 5.0, "SEG", "c"), (2, "B", "adr", 7, "ph", 5.0, "S", "c")]
    with with_conf({"spark.sql.autoBroadcastJoinThreshold": threshold}):
        customer = clean.clean_customer(frame(spark, rows, raw_schema("customer")))
        dim = star.dim_customer(customer, nation, region, strict=True)
        assert dim.columns == STAR_COLUMNS["dim_customer"]
        got = dim.select("c_custkey", "c_nationkey", "c_n_name", "c_regionkey", "c_r_name")
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(
            map(
                str,
                [
                    (1, 0, "ALGERIA", 0, "AFRICA"),
                    (2, 7, None, None, None),
                    (None, 1, "PERU", 1, "AMERICA"),
                    (None, 2, "NOWHERE", 9, None),
                    (None, None, None, 4, "MIDDLE"),
                ],
            )
        )


def test_dim_supplier(spark, nation, region):
    rows = [(1, "S", "adr", 1, "ph", 5.0, "c")]
    supplier = clean.clean_supplier(frame(spark, rows, raw_schema("supplier")))
    dim = star.dim_supplier(supplier, nation, region, strict=True)
    assert dim.columns == STAR_COLUMNS["dim_supplier"]
    assert dim.count() == 4
    row = dim.where("supp_suppkey = 1").first()
    assert (row.supp_n_name, row.supp_r_name, row.supp_comment) == ("PERU", "AMERICA", "c")


def test_dimension_over_a_geography_too_large_to_broadcast(spark, region):
    nation = spark.range(1_500).select(
        F.col("id").cast("int").alias("n_nationkey"),
        F.concat(F.lit("N"), "id").alias("n_name"),
        (F.col("id") % 6).cast("int").alias("n_regionkey"),
        F.lit("c").alias("n_comment"),
    )
    customer = spark.range(4_000).select(
        F.col("id").cast("int").alias("c_custkey"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 2_000).cast("int").alias("c_nationkey"),
    )
    dim = star.dim_customer(customer, nation, region)
    places = nation.join(
        region, nation.n_regionkey == region.r_regionkey, "outer"
    ).select("n_nationkey", "n_name", "r_name")
    expected = customer.join(
        places, customer.c_nationkey == places.n_nationkey, "outer"
    ).select(
        "c_custkey",
        F.coalesce("c_nationkey", "n_nationkey").alias("c_nationkey"),
        F.col("n_name").alias("c_n_name"),
        F.col("r_name").alias("c_r_name"),
    )
    columns = ["c_custkey", "c_nationkey", "c_n_name", "c_r_name"]
    assert bag(dim, columns) == bag(expected, columns)


def test_dim_part_keeps_both_unmatched_sides(spark):
    part = frame(
        spark,
        [(k, "n", "m", "b", "t", 1, "c", 1.0, "x") for k in (1, 2)],
        raw_schema("part"),
    )
    partsupp = frame(
        spark, [(1, 10, 5, 1.0, "p"), (3, 30, 5, 1.0, "q")], raw_schema("partsupp")
    )
    dim = star.dim_part(
        clean.clean_part(part), clean.clean_partsupp(partsupp), strict=True
    )
    assert dim.columns == STAR_COLUMNS["dim_part"]
    got = dim.select("p_partkey_suppkey", "p_partkey", "ps_suppkey", "p_name")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [("110", 1, 10, "n"), (None, 2, None, "n"), ("330", 3, 30, None)])
    )


def test_dimension_plan_broadcasts_the_geography_only(spark):
    sf = "/root/testdata/sf0.01"
    tables = [
        spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "nation", "region")
    ]
    df = star.dim_customer(*tables)
    df.collect()
    text = plan(df)
    joins = [line for line in text.splitlines() if "HashJoin" in line]
    assert any("LeftOuter, BuildRight" in line for line in joins)
    # The customer is read whole without an exchange, and once more for its key.
    assert "ReadSchema: struct<c_nationkey:int>" in text
    assert "hashpartitioning(c_custkey" not in text


def test_fact_plan_shuffles_each_table_once(spark, with_conf):
    sf = "/root/testdata/sf0.01"
    orders, lineitem = (
        spark.read.parquet(f"{sf}/{t}.parquet") for t in ("orders", "lineitem")
    )
    with with_conf({"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        fact = star.fact_sales(clean.clean_orders(orders), clean.clean_lineitem(lineitem))
        text = plan(fact)
        revenue = fact.groupBy("s_year").agg(F.sum("s_revenue").alias("revenue"))
        pruned = plan(revenue)
    # Both tables whole, once; beyond that, the distinct order keys of either side.
    wide = [line for line in text.splitlines() if "ReadSchema" in line and "," in line]
    assert text.count("Exchange hashpartitioning") == 4
    assert len(wide) >= 2 and "FullOuter" not in text
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    # Columns nobody asks for are not read.
    assert "l_extendedprice" in pruned and "l_returnflag" not in pruned
