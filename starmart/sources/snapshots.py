"""Published tables: whole snapshots behind one pointer.

A refresh writes every table to a folder of its own and then adds a manifest, a small
file that names them all. The manifest with the highest number is the current state, and
adding it is one step: readers get all tables of the old snapshot or all of the new one,
and a refresh that fails on the way leaves the old one as it was. Manifests are never
overwritten, so two refreshes that end at the same time cannot both take a number.

    <zone>/snapshots/<id>/<table>/...       files, never changed
    <zone>/manifests/000000000012.json      {"id": ..., "tables": {name: partition columns}}

``register_published`` shows the current snapshot in the catalog. Every name is a view,
and a view is replaced in one step as well; at no time is a name without a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starmart.sources.catalog import create_database, register_table, replace_view
from starmart.sources.files import names, read_text, remove_folder, write_new
from starmart.sources.zones import read_zone, write_zone

DIGITS = 12


@dataclass(frozen=True)
class Snapshot:
    number: int
    id: str
    tables: Mapping[str, Sequence[str]]

    def folder(self, zone: str) -> str:
        return f"{zone.rstrip('/')}/snapshots/{self.id}"


def _manifests(zone: str) -> str:
    return f"{zone.rstrip('/')}/manifests"


def versions(spark: SparkSession, zone: str) -> list[int]:
    """Numbers of the published snapshots, oldest first."""
    return [int(n[:DIGITS]) for n in names(spark, _manifests(zone)) if n.endswith(".json")]


def snapshot(spark: SparkSession, zone: str, number: int | None = None) -> Snapshot | None:
    """A published snapshot, the current one if no number is given."""
    known = versions(spark, zone)
    number = number or (known[-1] if known else None)
    if number is None:
        return None
    found = json.loads(read_text(spark, f"{_manifests(zone)}/{number:0{DIGITS}}.json"))
    return Snapshot(number, found["id"], found["tables"])


def publish(
    spark: SparkSession,
    zone: str,
    tables: Mapping[str, DataFrame],
    partitions: Mapping[str, Sequence[str]] | None = None,
    audit: Callable[[Mapping[str, DataFrame]], None] | None = None,
) -> Snapshot:
    """Write the tables as a new snapshot and make it the current one.

    ``audit`` gets the written tables before anybody else can see them; if it raises,
    nothing is published. Files of a snapshot that was not published are left to
    ``expire``.
    """
    number = max(versions(spark, zone), default=0) + 1
    partitions = partitions or {}
    own = Snapshot(number, uuid.uuid4().hex, {t: list(partitions.get(t, ())) for t in tables})
    folder = own.folder(zone)
    for table, df in tables.items():
        write_zone(df, folder, table, own.tables[table])
    if audit:
        audit({table: read_zone(spark, folder, table) for table in tables})
    manifest = json.dumps({"id": own.id, "tables": own.tables}, sort_keys=True)
    write_new(spark, f"{_manifests(zone)}/{number:0{DIGITS}}.json", manifest)
    return own


def read_published(
    spark: SparkSession, zone: str, table: str, number: int | None = None
) -> DataFrame:
    """A table of the current snapshot, or of an older one that has not expired."""
    found = snapshot(spark, zone, number)
    if found is None:
        raise ValueError(f"nothing is published in {zone}")
    return read_zone(spark, found.folder(zone), table)


def register_published(
    spark: SparkSession, zone: str, database: str, location: str | None = None
) -> Snapshot:
    """Point a database's views at the current snapshot."""
    found = snapshot(spark, zone)
    if found is None:
        raise ValueError(f"nothing is published in {zone}")
    create_database(spark, database, location)
    # All files are registered before the first view moves.
    stored = {}
    for table, partition_by in found.tables.items():
        path = f"{found.folder(zone)}/{table}"
        stored[table] = register_table(
            spark, database, f"{table}_{found.number}", path, partition_by, table
        )
    for table, name in stored.items():
        replace_view(spark, f"{database}.{table}", name)
    return found


def expire(spark: SparkSession, zone: str, keep: int = 2) -> list[int]:
    """Remove all snapshots but the last ``keep``, and what failed refreshes left.

    Manifests go first, so that no manifest names files that are gone. To be run while
    no refresh is under way. Returns the numbers that are gone.
    """
    if keep < 1:
        raise ValueError("the current snapshot cannot expire")
    known = versions(spark, zone)
    gone = known[:-keep]
    kept = {snapshot(spark, zone, number).id for number in known[-keep:]}
    for number in gone:
        remove_folder(spark, f"{_manifests(zone)}/{number:0{DIGITS}}.json")
    folder = f"{zone.rstrip('/')}/snapshots"
    for name in names(spark, folder):
        if name not in kept:
            remove_folder(spark, f"{folder}/{name}")
    return gone
