"""Marts published as tables, all at once.

A refresh writes every mart into a folder of its own run.  Only when all are
there is the run's manifest put in place, by one rename: that is the switch.
Whoever opens the marts reads the newest manifest and takes all of them from
its run, so no reader sees a mix, and a refresh that dies leaves only a folder
that no manifest names.  Catalog tables are pointed at the run afterwards.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import delete_path, file_system, list_folders

MANIFEST = "manifest"


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under another name first, then renamed."""
    fs, target, jvm = file_system(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, target):
        fs.delete(part, False)
        raise FileExistsError(f"{path} could not be put in place")


def get_file(spark: SparkSession, path: str) -> str | None:
    """Text of a small file (None: there is none)."""
    fs, target, jvm = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def runs(spark: SparkSession, root: str) -> list[int]:
    """Published runs, oldest first."""
    fs, _, jvm = file_system(spark, root)
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFEST}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def publish(spark: SparkSession, marts: dict[str, DataFrame], root: str, database: str | None = None, max_parallel_writes: int = 4) -> int:
    """Write all marts as the next run and switch to it; returns the run.
    Any mart that fails leaves the run before in place."""
    run = (runs(spark, root) or [0])[-1] + 1
    folder = f"{root}/run={run:06d}"
    delete_path(spark, folder)  # what a refresh that died has left
    with ThreadPoolExecutor(max_workers=min(max_parallel_writes, len(marts))) as pool:
        for done in [pool.submit(df.write.parquet, f"{folder}/{name}") for name, df in marts.items()]:
            done.result()
    schemas = {name: spark.read.parquet(f"{folder}/{name}").schema.json() for name in marts}
    put_file(spark, f"{root}/{MANIFEST}/{run:06d}.json", json.dumps({"run": run, "marts": schemas}))
    if database:
        point_tables(spark, root, database)
    return run


def open_marts(spark: SparkSession, root: str, run: int | None = None) -> dict[str, DataFrame]:
    """All marts of one run (by default the newest published one)."""
    from pyspark.sql.types import StructType

    run = run if run is not None else (runs(spark, root) or [None])[-1]
    text = get_file(spark, f"{root}/{MANIFEST}/{run:06d}.json") if run is not None else None
    if text is None:
        raise FileNotFoundError(f"no published marts in {root}")
    return {name: spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{root}/run={run:06d}/{name}")
            for name, schema in json.loads(text)["marts"].items()}


def point_tables(spark: SparkSession, root: str, database: str) -> None:
    """Catalog tables of the newest run: made where missing, else moved to
    its folder."""
    for name, df in open_marts(spark, root).items():
        location, table = df.inputFiles()[0].rsplit("/", 1)[0], f"`{database}`.`{name}`"
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(f"{database}.{name}")
        else:
            spark.catalog.createTable(f"{database}.{name}", path=location, source="parquet", schema=df.schema)


def drop_old_runs(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the newest published runs and their manifests, and
    folders that no manifest names."""
    kept = {f"run={r:06d}" for r in runs(spark, root)[-keep:]}
    for r in runs(spark, root)[:-keep]:
        delete_path(spark, f"{root}/{MANIFEST}/{r:06d}.json")
    gone = [n for n in list_folders(spark, root) if n.startswith("run=") and n not in kept]
    for n in gone:
        delete_path(spark, f"{root}/{n}")
    return gone
