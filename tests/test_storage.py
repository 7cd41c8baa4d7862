"""Snapshots, buckets, counters at write time, and one parse per text table."""

import pytest
from pyspark.sql import functions as F

from starmart.plans import jobs, star
from starmart.plans.quality import observable_counters
from starmart.schemas import TABLES, raw_schema
from starmart.sources import (
    bucket_count,
    catalog,
    create_database,
    expire,
    land_raw,
    publish,
    read_published,
    register_published,
    split_raw,
    write_bucketed,
    write_counted,
    write_zone,
)
from starmart.sources.files import names, stored_bytes, write_new
from starmart.sources.snapshots import snapshot, versions
from tests.conftest import bag, plan
from tests.test_sources_and_jobs import LINES


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for table, lines in LINES.items():
        (folder / f"{table}.tbl").write_text("\n".join(lines) + "\n")
    return str(folder)


def facts(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("s_orderkey_linenumber"),
        (F.lit(1990) + F.col("id") % 3).cast("int").alias("s_year"),
    )


def parts(spark, n):
    return spark.range(n).select(F.col("id").alias("p_partkey"))


def both(spark, n):
    return {"fact_sales": facts(spark, n), "dim_part": parts(spark, n)}


# --- snapshots ------------------------------------------------------------------


def test_readers_get_whole_snapshots(spark, tmp_path):
    zone = str(tmp_path / "star")
    assert snapshot(spark, zone) is None and versions(spark, zone) == []
    for n in (3, 5):
        publish(spark, zone, both(spark, n), {"fact_sales": ["s_year"]})
        sizes = {t: read_published(spark, zone, t).count() for t in ("fact_sales", "dim_part")}
        assert sizes == {"fact_sales": n, "dim_part": n}
    old = read_published(spark, zone, "fact_sales", 1)
    assert old.count() == 3 and dict(old.dtypes)["s_year"] == "int"
    with pytest.raises(ValueError, match="nothing is published"):
        read_published(spark, str(tmp_path / "none"), "dim_part")


def test_a_failed_refresh_changes_nothing(spark, tmp_path):
    zone = str(tmp_path / "star")
    publish(spark, zone, both(spark, 4))
    register_published(spark, zone, "kept_views", str(tmp_path / "db"))

    def refuse(tables):
        assert tables["dim_part"].count() == 9
        raise RuntimeError("not good enough")

    with pytest.raises(RuntimeError):
        publish(spark, zone, both(spark, 9), audit=refuse)
    broken = both(spark, 9)
    broken["dim_part"] = parts(spark, 9).select(F.raise_error(F.lit("lost")).alias("p_partkey"))
    with pytest.raises(Exception, match="lost"):
        publish(spark, zone, broken)
    register_published(spark, zone, "kept_views")
    assert versions(spark, zone) == [1]
    assert spark.table("kept_views.fact_sales").count() == 4
    assert spark.table("kept_views.dim_part").count() == 4


def test_views_move_and_old_tables_stay_readable(spark, tmp_path):
    zone = str(tmp_path / "star")
    publish(spark, zone, both(spark, 2), {"fact_sales": ["s_year"]})
    register_published(spark, zone, "moving_views", str(tmp_path / "db"))
    publish(spark, zone, both(spark, 7), {"fact_sales": ["s_year"]})
    assert spark.table("moving_views.fact_sales").count() == 2
    register_published(spark, zone, "moving_views")
    assert spark.table("moving_views.fact_sales").count() == 7
    assert spark.table("moving_views.fact_sales").columns == ["s_orderkey_linenumber", "s_year"]
    assert spark.table("moving_views.fact_sales_1").count() == 2


def test_two_refreshes_cannot_take_one_number(spark, tmp_path):
    path = f"{tmp_path}/manifests/000000000001.json"
    write_new(spark, path, "first")
    with pytest.raises(FileExistsError):
        write_new(spark, path, "second")
    assert names(spark, f"{tmp_path}/manifests") == ["000000000001.json"]


def test_expiry_keeps_what_is_named(spark, tmp_path):
    zone = str(tmp_path / "star")
    for n in (1, 2, 3, 4):
        publish(spark, zone, {"dim_part": parts(spark, n)})
    with pytest.raises(RuntimeError):
        publish(spark, zone, {"dim_part": parts(spark, 9)}, audit=lambda tables: fail())
    assert len(names(spark, f"{zone}/snapshots")) == 5
    assert expire(spark, zone, keep=2) == [1, 2]
    assert versions(spark, zone) == [3, 4]
    assert len(names(spark, f"{zone}/snapshots")) == 2
    assert read_published(spark, zone, "dim_part", 3).count() == 3
    assert read_published(spark, zone, "dim_part").count() == 4
    with pytest.raises(ValueError):
        expire(spark, zone, keep=0)


def fail():
    raise RuntimeError("refused")


def test_publish_job_checks_before_it_shows(spark, raw, tmp_path):
    zones = [str(tmp_path / name) for name in ("clean", "star")]
    jobs.run_clean(spark, raw, zones[0])
    found = jobs.run_publish(spark, *zones, "checked", str(tmp_path / "db"))
    assert found.number == 1 and spark.table("checked.dim_customer").count() == 3
    with open(f"{raw}/customer.tbl", "a") as customers:
        customers.write(LINES["customer"][0] + "\n")
    jobs.run_clean(spark, raw, zones[0])
    with pytest.raises(Exception, match="Duplicate customer primary key found"):
        jobs.run_publish(spark, *zones, "checked")
    assert spark.table("checked.dim_customer").count() == 3
    assert versions(spark, zones[1]) == [1]


# --- buckets --------------------------------------------------------------------


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, with_conf):
    create_database(spark, "buckets", str(tmp_path / "db"))
    orders = spark.range(500).select(F.col("id").alias("o_orderkey"), F.lit("x").alias("o_clerk"))
    lines = spark.range(2000).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 600).alias("l_orderkey"),
        F.col("id").alias("l_linenumber"),
    )
    stored = [
        spark.table(write_bucketed(df, "buckets", name, str(tmp_path / name), key, 4))
        for name, df, key in (("orders", orders, "o_orderkey"), ("lineitem", lines, "l_orderkey"))
    ]
    with with_conf({"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = star.fact_sales(*stored)
        rows = bag(joined)
        assert "Exchange" not in plan(joined)
    assert rows == bag(star.fact_sales(orders, lines))
    files = [n for n in names(spark, str(tmp_path / "orders")) if n.endswith(".parquet")]
    assert len(files) == 4


def test_buckets_follow_the_size_of_the_largest_table(spark, tmp_path, monkeypatch, with_conf):
    paths = [str(tmp_path / name) for name in ("few", "many")]
    for path, n in zip(paths, (10, 50_000), strict=True):
        spark.range(n).select(F.md5(F.col("id").cast("string"))).coalesce(1).write.parquet(path)
    assert bucket_count(spark, paths) == 1 and bucket_count(spark, paths, 8) == 8
    monkeypatch.setattr(catalog, "BUCKET_BYTES", 2**16)
    found = bucket_count(spark, paths, 8)
    assert 20 < found < 60 and bucket_count(spark, paths[:1], 8) == 8
    with with_conf({"spark.sql.sources.bucketing.maxBuckets": "12"}):
        assert bucket_count(spark, paths) == 12


# --- counters at write time -----------------------------------------------------


@pytest.mark.parametrize("partitions", [[], ["s_year"]])
def test_counters_of_a_written_table(spark, tmp_path, partitions):
    df = spark.sql(
        "SELECT * FROM VALUES ('11', 1990), (NULL, 1991), ('11', 1991), (NULL, NULL) "
        "AS v(s_orderkey_linenumber, s_year)"
    )
    counters = observable_counters("s_orderkey_linenumber")
    counted = write_counted(df, str(tmp_path), "fact_sales", counters, partitions)
    assert counted == {"n_keys": 2, "n_null": 2}
    assert spark.read.parquet(f"{tmp_path}/fact_sales").count() == 4
    empty = write_counted(df.where("false"), str(tmp_path), "fact_sales", counters, partitions)
    assert empty == {"n_keys": 0, "n_null": 0}


# --- what is written ---


def test_a_partitioned_write_shuffles_only_when_asked(spark, tmp_path):
    df = facts(spark, 400).repartition(4)
    for rebalance, files in ((False, 4), (True, 1)):
        zone = str(tmp_path / f"rebalance_{rebalance}")
        path = write_zone(df, zone, "fact_sales", ["s_year"], rebalance)
        for year in (1990, 1991, 1992):
            stored = [n for n in names(spark, f"{path}/s_year={year}") if "parquet" in n]
            assert len(stored) == files and ".zstd" in stored[0]
        assert bag(spark.read.parquet(path)) == bag(facts(spark, 400))


def test_landing_writes_less_than_it_reads(spark, raw, tmp_path):
    line = LINES["lineitem"][0]
    with open(f"{raw}/lineitem.tbl", "w") as lines:
        lines.writelines(f"{n}{line}\n" for n in range(2_000))
    jobs.run_land(spark, raw, str(tmp_path / "raw"))
    read, landed = (f"{folder}/lineitem.tbl" for folder in (raw, tmp_path / "raw"))
    assert 0 < stored_bytes(spark, landed) < stored_bytes(spark, read) / 4
    assert bag(spark.read.text(landed)) == bag(spark.read.text(read))


# --- one parse ------------------------------------------------------------------


class Scans:
    """Text tables read while the block runs, by the jobs that Spark was given."""

    def __init__(self, monkeypatch):
        self.read = []
        original = jobs.read_raw

        def counted(spark, folder, table, *args, **kwargs):
            self.read.append(table)
            return original(spark, folder, table, *args, **kwargs)

        monkeypatch.setattr(jobs, "read_raw", counted)


def test_constraints_parse_each_table_once(spark, raw, tmp_path, monkeypatch):
    scans, plans = Scans(monkeypatch), []
    original = jobs.key_summary

    def kept(tables):
        plans.append(original(tables))
        return plans[-1]

    monkeypatch.setattr(jobs, "key_summary", kept)
    report = jobs.run_constraints(spark, raw, str(tmp_path / "report"))
    assert sorted(scans.read) == sorted(TABLES)
    # Everything that is not counted during that one read is checked on Parquet.
    assert "FileScan csv" not in plan(plans[0]) and "FileScan parquet" in plan(plans[0])
    tables = {t: jobs.read_raw(spark, raw, t) for t in TABLES}
    assert bag(report) == bag(jobs.constraint_summary(tables))


def test_a_key_table_is_one_scan_of_text(spark, raw, tmp_path):
    keys, rows = jobs.staged_keys(jobs.read_raw(spark, raw, "lineitem"), "lineitem", str(tmp_path))
    assert keys.columns == ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    assert ("lineitem", "not_null(l_comment)", 0) in rows and len(rows) == 16


def test_rejects_come_from_the_parse_of_the_rows(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    good = LINES["orders"][0]
    (folder / "orders.tbl").write_text(f"{good}\nx{good}\n3|1\n{good}\n")
    rows, rejected = split_raw(spark, str(folder), "orders", str(tmp_path / "staging"))
    assert rows.columns == raw_schema("orders").names and rows.count() == 4
    assert sorted(r.rejected_line for r in rejected.collect()) == ["3|1", f"x{good}"]
    for df in (rows, rejected):
        assert "FileScan csv" not in plan(df)
    assert "PartitionFilters: [isnotnull(is_rejected" in plan(rejected)
    (folder / "orders.tbl").write_text("")
    rows, rejected = split_raw(spark, str(folder), "orders", str(tmp_path / "staging"))
    assert rows.count() == 0 and rejected.count() == 0


def test_landing_keeps_carriage_returns(spark, tmp_path):
    text = b"1|a\rb|\r\n2|\r|\n\r\n3|x|"
    (tmp_path / "t.tbl").write_bytes(text)
    target = land_raw(spark, str(tmp_path / "t.tbl"), str(tmp_path / "raw"), "t")
    files = [n for n in names(spark, target) if n.startswith("part-")]
    landed = b"".join(open(f"{target}/{n}", "rb").read() for n in files)
    assert landed == text + b"\n"


def test_the_whole_chain_can_start_with_landing(spark, raw, tmp_path):
    zones = [str(tmp_path / name) for name in ("raw", "clean", "star")]
    report = jobs.run_all(
        spark, *zones, "landed_first", location=str(tmp_path / "db"), source=raw
    )
    assert tuple(report.first()) == (None, "all good")
