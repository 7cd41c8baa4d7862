"""Text tables, zones, registered tables and the whole chain of jobs."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from starmart.plans import jobs
from starmart.schemas import (
    CLEAN_COLUMNS,
    LINEITEM_LAYOUTS,
    STAR_COLUMNS,
    STAR_TABLES,
    TABLES,
    raw_schema,
)
from starmart.session import scratch_dir
from starmart.sources import (
    create_database,
    land_raw,
    read_raw,
    read_tbl,
    read_zone,
    register_table,
    tbl_path,
    write_tbl,
    write_zone,
)

LINES = {
    "region": ["0|AFRICA|lar deposits|", "1|AMERICA||"],
    "nation": ["0|ALGERIA|0|furious|", "1|ARGENTINA|1|final|", "2|BRAZIL|1|bold|"],
    "customer": [
        "1|Customer#1|adr one|0|10-1|700.50|BUILDING|quick|",
        "2|Customer#2| adr two|1|11-2|-3.25|MACHINERY|slow|",
    ],
    "supplier": ["10|Supplier#10| lead blank|1|27-9|5755.94|careful|"],
    "part": [
        "7|linen|Manufacturer#1|Brand#13|PROMO|7|JUMBO PKG|901.00|ly|",
        "8|tan|Manufacturer#2|Brand#21|LARGE|1|LG CASE|902.00|ru|",
    ],
    "partsupp": ["7|10|3325|771.64|even|"],
    "orders": [
        "1|1|O|173665.47|1996-01-02|5-LOW|Clerk#951|0|nstructions|",
        "2|2|F|46929.18|1995-12-01|1-URGENT|Clerk#880|0|foxes|",
    ],
    "lineitem": [
        "1|7|10|1|17|21168.23|0.04|0.02|N|O|1996-03-13|1996-02-12|1996-03-22|"
        "DELIVER IN PERSON|TRUCK|egular|",
        "1|7|10|2|36|45983.16|0.09|0.06|N|O|1996-04-12|1996-02-28|1996-04-20|"
        "TAKE BACK RETURN|MAIL|ly final|",
    ],
}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for table, lines in LINES.items():
        (folder / f"{table}.tbl").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_raw_schemas():
    sizes = {t: len(raw_schema(t)) + 1 for t in TABLES}
    assert sizes == {
        "customer": 9,
        "supplier": 8,
        "nation": 5,
        "region": 4,
        "part": 10,
        "partsupp": 6,
        "orders": 10,
        "lineitem": 17,
    }
    assert all(f.nullable for t in TABLES for f in raw_schema(t).fields)
    assert raw_schema("lineitem", "named").names[:3] == ["l_id", "l_orderkey", "l_ps_id"]
    assert set(LINEITEM_LAYOUTS) == {"stock", "named"}


@pytest.mark.parametrize("table", TABLES)
def test_read_raw(spark, raw, table):
    df = read_raw(spark, raw, table)
    expected = raw_schema(table).names + (["l_id"] if table == "lineitem" else [])
    assert df.columns == expected
    assert df.count() == len(LINES[table])


def test_values_and_leading_blanks(spark, raw):
    supplier = read_raw(spark, raw, "supplier").first()
    assert supplier.s_address == " lead blank" and supplier.s_acctbal == 5755.94
    region = read_raw(spark, raw, "region").orderBy("r_regionkey").collect()
    assert region[1].r_comment is None
    order = read_raw(spark, raw, "orders").where("o_orderkey = 1").first()
    assert str(order.o_orderdate) == "1996-01-02 00:00:00"


def test_malformed_values_keep_the_row(spark, tmp_path):
    path = tmp_path / "orders.tbl"
    path.write_text(
        "x|1|O|1.5|1996-01-02|5-LOW|c|0|bad int|\n"
        "2|1|O|1.5|1996-13-02|5-LOW|c|0|month 13|\n"
        "3|1\n"
        "4|1|O|1.5|1996-01-02|5-LOW|c|0||\n"
    )
    schema = raw_schema("orders")
    rows = read_tbl(spark, str(path), schema).collect()
    assert [r.o_orderkey for r in rows] == [None, 2, 3, 4]
    assert rows[0].o_comment == "bad int"
    assert rows[1].o_orderdate is None and rows[1].o_comment == "month 13"
    assert rows[2].o_custkey == 1 and rows[2].o_comment is None
    assert rows[3].o_comment is None

    with_rejects = read_tbl(spark, str(path), schema, corrupt_column="reject").collect()
    assert [r.reject is not None for r in with_rejects] == [True, True, True, False]
    assert with_rejects[2].reject == "3|1"
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_tbl(spark, str(path), schema, mode="FAILFAST").collect()
    whole_lines = read_tbl(spark, str(path), schema, mode="DROPMALFORMED").collect()
    assert [r.o_orderkey for r in whole_lines] == [4]


def test_land_raw_copies_lines(spark, raw, tmp_path):
    target = land_raw(spark, tbl_path(raw, "nation"), str(tmp_path / "raw"), "nation")
    assert [r.value for r in spark.read.text(target).collect()] == LINES["nation"]


def test_write_tbl_ends_lines_in_separator(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string").coalesce(1)
    write_tbl(df, str(tmp_path / "t.tbl"))
    text = spark.read.text(str(tmp_path / "t.tbl"))
    assert [r.value for r in text.collect()] == ["1|a|", "2||"]


def test_written_text_reads_back_the_same(spark, tmp_path):
    texts = ["  lead ", "", None, 'say "x"', '"', "a|b", "back\\\\slash", "end\\\\", "\\\\|", "\t"]
    texts += ['"\\\\', "'", '""', "#", "ü\u2028"]
    rows = [(i, t, 0.1 + i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k bigint, t string, d double").withColumn(
        "ts", F.expr("TIMESTAMP '2001-02-03 04:05:06.123456'")
    )
    df = df.withColumn("ntz", F.expr("TIMESTAMP_NTZ '2001-02-03 00:00:00.000001'"))
    write_tbl(df, str(tmp_path / "t.tbl"))
    back = read_tbl(spark, str(tmp_path / "t.tbl"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("text", ["two\nlines", "two\rlines", "nul\0"])
def test_texts_that_a_line_cannot_hold_are_refused(spark, tmp_path, text):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="line break"):
        write_tbl(df, str(tmp_path / "t.tbl"))


def test_strict_zone_and_all_null_partitions(spark, tmp_path):
    df = spark.sql("SELECT '1' AS s_orderkey_linenumber, CAST(NULL AS INT) AS s_year")
    write_zone(df, str(tmp_path), "fact_sales", ["s_year"])
    back = read_zone(spark, str(tmp_path), "fact_sales")
    assert dict(back.dtypes)["s_year"] == "int" and back.count() == 1
    with pytest.raises(ValueError, match="missing"):
        read_zone(spark, str(tmp_path), "fact_sales", strict=True)
    write_zone(spark.range(1).withColumnRenamed("id", "extra"), str(tmp_path), "region")
    with pytest.raises(ValueError, match="beyond"):
        read_zone(spark, str(tmp_path), "region", strict=True)


def test_keys_beyond_the_range_of_an_integer(spark, raw, tmp_path):
    big = 3_000_000_000
    landing = tmp_path / "landing"
    orders, lines = LINES["orders"][0], LINES["lineitem"][0]
    (landing / "orders.tbl").write_text(f"{big}{orders[1:]}\n")
    (landing / "lineitem.tbl").write_text(f"{big}{lines[1:]}\n")
    zones = [raw, *[str(tmp_path / name) for name in ("clean", "star")]]
    jobs.run_all(spark, *zones, "big_keys", location=str(tmp_path / "it's here"))
    row = spark.table("big_keys.fact_sales").first()
    assert (row.s_orderkey, row.s_orderkey_linenumber) == (big, f"{big}1")
    assert (row.s_custkey, row.s_linenumber) == (1, 1)


def test_rejects_constraints_and_corrected_counts(spark, raw, tmp_path, capsys):
    landing = tmp_path / "landing"
    bad = "x|1|O|1.5|1996-01-02|5-LOW|c|0|bad int|"
    with (landing / "orders.tbl").open("a") as orders:
        orders.write(bad + "\n")
    names = ("clean", "star", "db", "rejects", "report")
    zones = {name: str(tmp_path / name) for name in names}
    chain = ["all", "--raw", raw, "--clean", zones["clean"], "--star", zones["star"]]
    chain += ["--database", "options", "--location", zones["db"]]
    chain += ["--nulls", "corrected", "--on-fail", "return", "--rejects", zones["rejects"]]
    jobs.main(chain)
    assert "NULL sales primary key found" in capsys.readouterr().out
    rejected = spark.read.parquet(zones["rejects"] + "/orders").collect()
    assert [(r.o_orderkey, r.o_custkey, r.rejected_line) for r in rejected] == [(None, 1, bad)]
    jobs.main(["constraints", "--raw", raw, "--report", zones["report"]])
    report = {tuple(r)[:2]: r.violations for r in spark.read.parquet(zones["report"]).collect()}
    assert report[("orders", "not_null(o_orderkey)")] == 1
    assert report[("lineitem", "foreign_key(l_partkey, l_suppkey -> partsupp)")] == 0
    assert report[("partsupp", "primary_key(ps_partkey, ps_suppkey)")] == 0
    assert len(report) == 59 + 8 + 8
    short = jobs.constraint_summary({"region": spark.range(1).selectExpr("id AS r_regionkey")})
    assert ("region", "present(r_name)", 1) in [tuple(r) for r in short.collect()]


def test_partitioned_zone_keeps_contract_order_and_nulls(spark, tmp_path):
    df = spark.sql(
        "SELECT '11' AS s_orderkey_linenumber, y AS s_year, 'Jan' AS s_month "
        "FROM VALUES (1992), (NULL), (1993), (1993) AS v(y)"
    )
    zone = str(tmp_path)
    path = write_zone(df, zone, "fact_sales", ["s_year"])
    assert sorted(p for p in os.listdir(path) if p.startswith("s_year")) == [
        "s_year=1992",
        "s_year=1993",
        "s_year=__HIVE_DEFAULT_PARTITION__",
    ]
    back = read_zone(spark, zone, "fact_sales")
    assert back.dtypes == df.dtypes
    assert sorted(r.s_year or 0 for r in back.collect()) == [0, 1992, 1993, 1993]
    write_zone(df.limit(1), zone, "fact_sales", ["s_year"])
    assert read_zone(spark, zone, "fact_sales").count() == 1


def test_register_again_points_to_new_files(spark, tmp_path):
    for n in (1, 2):
        spark.range(n).write.parquet(str(tmp_path / f"v{n}"))
    create_database(spark, "reg_test", str(tmp_path / "db"))
    create_database(spark, "reg_test", str(tmp_path / "db"))
    for n in (1, 2):
        name = register_table(spark, "reg_test", "dim_part", str(tmp_path / f"v{n}"))
        assert spark.table(name).count() == n
    assert spark.read.parquet(str(tmp_path / "v1")).count() == 1


def test_whole_chain(spark, raw, tmp_path):
    zones = {name: str(tmp_path / name) for name in ("raw", "clean", "star", "db")}
    jobs.run_land(spark, raw, zones["raw"])
    for _ in range(2):  # A second run overwrites the first.
        report = jobs.run_all(
            spark, zones["raw"], zones["clean"], zones["star"], "chain",
            location=zones["db"],
        )
        assert tuple(report.first()) == (None, "all good")
    for table in TABLES:
        df = read_zone(spark, zones["clean"], table)
        assert df.columns == CLEAN_COLUMNS[table]
        assert df.count() == len(LINES[table])
    for table in STAR_TABLES:
        assert read_zone(spark, zones["star"], table).columns == STAR_COLUMNS[table]
        assert spark.table(f"chain.{table}").columns == STAR_COLUMNS[table]
    sales = spark.sql(
        "SELECT s_orderkey_linenumber, s_custkey, s_suppkey, s_id, s_year, s_month, "
        "round(s_revenue, 2) AS revenue FROM chain.fact_sales ORDER BY s_orderkey, 1"
    ).collect()
    assert [tuple(r) for r in sales] == [
        ("11", 1, 10, 1, 1996, "Jan", 21168.17),
        ("12", 1, 10, 1, 1996, "Jan", 45983.01),
        (None, 2, None, None, 1995, "Dec", None),
    ]
    classes = read_zone(spark, zones["clean"], "customer").orderBy("c_custkey")
    assert [r.c_acctbal_class for r in classes.collect()] == ["above_average", "negative"]
    assert spark.table("chain.dim_customer").count() == 3
    assert spark.table("chain.dim_supplier").count() == 3
    keys = spark.table("chain.dim_part").orderBy("p_partkey").collect()
    assert [r.p_partkey_suppkey for r in keys] == ["710", None]
    types = dict(spark.table("chain.fact_sales").dtypes)
    assert types["s_linenumber"] == "bigint" and types["s_suppkey"] == "bigint"
    assert types["s_year"] == "int"
    corrected = jobs.run_quality(spark, "chain", nulls="corrected", on_fail="return")
    assert corrected.first().issues_found == 4


def test_jobs_one_by_one_and_a_failing_gate(spark, raw, tmp_path, capsys):
    zones = {name: str(tmp_path / name) for name in ("raw", "clean", "star", "db")}
    customer = tmp_path / "landing" / "customer.tbl"
    customer.write_text(customer.read_text() + LINES["customer"][0] + "\n")
    jobs.main(["land", "--source", raw, "--raw", zones["raw"]])
    jobs.main(["clean", "--raw", zones["raw"], "--clean", zones["clean"]])
    jobs.main(["star", "--clean", zones["clean"], "--star", zones["star"]])
    place = ["--star", zones["star"], "--database", "single", "--location", zones["db"]]
    jobs.main(["register", *place])
    assert spark.table("single.dim_customer").count() == 4
    with pytest.raises(Exception, match="Duplicate customer primary key found"):
        jobs.main(["quality", *place])
    assert "all good" not in capsys.readouterr().out


def test_named_layout(spark, raw):
    df = read_raw(spark, raw, "lineitem", "named")
    row = df.where("l_linenumber = 1").first()
    assert (row.l_id, row.l_orderkey, row.l_ps_id) == (1, 7, 10)


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        jobs.run_clean(spark, str(tmp_path / "none"), str(tmp_path / "clean"))


def test_scratch_dir_follows_the_session(spark):
    class Session:
        """Only what scratch_dir asks for: the setting and the master."""

        def __init__(self, master, **conf):
            self.sparkContext = SimpleNamespace(master=master)
            self.conf = SimpleNamespace(get=lambda key, default: conf.get("dir", default))

    cluster = Session("yarn", dir="hdfs://shared/checkpoints/")
    first, second = scratch_dir(cluster), scratch_dir(cluster)
    assert first.startswith("hdfs://shared/checkpoints/starmart-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"))
    assert os.path.isdir(scratch_dir(Session("local[2]")))


def test_command_line(raw, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [
            sys.executable, os.path.join(root, "run_starmart.py"), "all",
            "--raw", raw, "--clean", str(tmp_path / "clean"),
            "--star", str(tmp_path / "star"), "--location", str(tmp_path / "db"),
        ],
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"},
        capture_output=True,
        text=True,
        timeout=300,
        check=False,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "all good" in done.stdout
