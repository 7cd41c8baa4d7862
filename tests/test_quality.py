import pytest
from pyspark.sql import functions as F

from starmart.operators import (
    foreign_key_summary,
    foreign_key_violations,
    not_null_summary,
    not_null_violations,
    primary_key_summary,
    primary_key_violations,
)
from starmart.plans.quality import (
    SUBJECTS,
    alert_rows,
    alert_summary,
    gate,
    key_checks,
)
from starmart.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS


def star(spark, **keys):
    """Star tables of one key column each; by default one row, key ``1``."""
    return {
        table: spark.createDataFrame([(k,) for k in keys.get(label, ["1"])], f"{key} string")
        for table, key, _, label in SUBJECTS
    }


def alerts(spark, nulls="literal", **keys):
    rows = alert_rows(star(spark, **keys), nulls).orderBy("check_no").collect()
    assert [r.check_no for r in rows] == list(range(1, 11))
    return [r.alerts for r in rows if r.alerts is not None]


def report(spark, nulls="literal", **keys):
    return alert_summary(alert_rows(star(spark, **keys), nulls))


def test_no_alerts(spark):
    summary = report(spark)
    assert tuple(summary.first()) == (None, None)
    assert tuple(gate(summary, "wh").first()) == (None, "all good")


def test_empty_tables(spark):
    assert alerts(spark, customer=[]) == ["Customer data missing; "]
    assert alerts(spark, sales=[], customer=[], supplier=[], part=[]) == [
        "Sales data missing; ",
        "Customer data missing; ",
        "Supplier data missing; ",
        "Part data missing; ",
    ]


def test_duplicates_are_checked_for_customer_and_supplier_only(spark):
    twice = ["1", "1"]
    found = alerts(spark, sales=twice, customer=twice, supplier=twice, part=twice)
    assert found == [
        "Duplicate customer primary key found; ",
        "Duplicate supplier primary key found; ",
    ]


def test_null_keys_literal_and_corrected(spark):
    keys = {"sales": ["1", None, None], "part": ["1", None]}
    assert alerts(spark, **keys) == []
    assert alerts(spark, "corrected", **keys) == [
        "2 NULL sales primary key found",
        "1 NULL part primary key found",
    ]


def test_null_counters(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert key_checks(df, "k", unique=True).first().asDict() == {
        "k_count": 2,
        "k_unique": 1,
        "k_null": 0,
        "k_null_rows": 1,
    }
    literal = F.countDistinct(F.when(F.col("k").isNull(), F.col("k")))
    assert df.agg(literal).first()[0] == 0


def test_two_alerts_and_the_gate(spark):
    summary = report(spark, sales=[], part=[])
    text = "Sales data missing; .; Part data missing; "
    assert tuple(summary.first()) == (text, 2)
    message = (
        "ATTENTION: wh. has potential data quality issues for yesterday: "
        f"{text}. for more info."
    )
    assert tuple(gate(summary, "wh", on_fail="return").first()) == (2, message)
    with pytest.raises(Exception, match="ATTENTION: wh. has potential"):
        gate(summary, "wh").collect()


def test_all_ten_checks_can_be_listed_in_order(spark):
    summary = report(spark, "corrected", sales=[None], customer=[None], supplier=["1", "1"], part=[])
    text = summary.first()[0]
    assert text == (
        "Sales data missing; .; 1 NULL sales primary key found.; "
        "Customer data missing; .; 1 NULL customer primary key found.; "
        "Duplicate supplier primary key found; .; Part data missing; "
    )


def test_wrong_options(spark):
    with pytest.raises(ValueError):
        alert_rows(star(spark), "other")
    with pytest.raises(ValueError):
        gate(report(spark), "wh", on_fail="other")


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, "x")], "a int, b string")
    rows = not_null_summary(df, "t", ["a", "b"]).collect()
    assert [tuple(r) for r in rows] == [("t", "not_null(a)", 1), ("t", "not_null(b)", 2)]
    assert not_null_violations(df, ["a", "b"]).count() == 2
    assert not_null_violations(df, ["a"]).count() == 1


def test_primary_key(spark):
    rows = [(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1), (None, 1), (None, 1)]
    df = spark.createDataFrame(rows, "a int, b int")
    found = primary_key_violations(df, ["a", "b"]).orderBy("a").collect()
    assert [tuple(r) for r in found] == [(1, 1, 2), (2, 1, 3)]
    assert tuple(primary_key_summary(df, "t", ["a", "b"]).first()) == (
        "t",
        "primary_key(a, b)",
        2,
    )
    assert primary_key_summary(df.limit(0), "t", ["a"]).first().violations == 0


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (None,), (9,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "pk int")
    bad = foreign_key_violations(child, ["fk"], parent, ["pk"]).collect()
    assert [tuple(r) for r in bad] == [(9,), (9,)]
    summary = foreign_key_summary(child, "c", ["fk"], parent, "p", ["pk"])
    assert tuple(summary.first()) == ("c", "foreign_key(fk -> p)", 2)
    clean = foreign_key_summary(child.where("fk = 1"), "c", ["fk"], parent, "p", ["pk"])
    assert clean.first().violations == 0


def test_foreign_key_with_many_unknown_keys(spark):
    child = spark.range(3_000).withColumnRenamed("id", "fk")
    parent = spark.range(100).withColumnRenamed("id", "pk")
    bad = foreign_key_violations(child, ["fk"], parent, ["pk"])
    assert bad.count() == 2_900


def test_composite_foreign_key(spark):
    lineitem = spark.createDataFrame(
        [(1, 10), (1, 11), (1, None), (None, 10)], "l_partkey int, l_suppkey int"
    )
    partsupp = spark.createDataFrame([(1, 10)], "ps_partkey int, ps_suppkey int")
    child_key, parent_key = FOREIGN_KEYS[-1][1], FOREIGN_KEYS[-1][3]
    bad = foreign_key_violations(lineitem, child_key, partsupp, parent_key).collect()
    assert [tuple(r) for r in bad] == [(1, 11)]
    summary = foreign_key_summary(
        lineitem, "lineitem", child_key, partsupp, "partsupp", parent_key
    )
    assert tuple(summary.first()) == (
        "lineitem",
        "foreign_key(l_partkey, l_suppkey -> partsupp)",
        1,
    )


def test_declared_constraints():
    assert sum(map(len, NOT_NULL.values())) == 59
    assert len(PRIMARY_KEYS) == 8 and len(FOREIGN_KEYS) == 8
