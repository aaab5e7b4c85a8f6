"""Spark session defaults and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates, ANSI casts, adaptive execution
# (coalescing, skew-join splitting, runtime broadcast conversion) and dynamic
# partition overwrite so a weekly rewrite touches only its own week.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcast only what is proven small: static size estimates come from
    # file sizes and miss computed columns, so planner-side auto-broadcast is
    # off; joins are broadcast by explicit, row-count-checked hints or by
    # adaptive execution from measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(largest_shuffle_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20, split_bytes: int = 512 << 20,
                 max_waves: int = 4) -> dict[str, str]:
    """Sizing for a cluster run.

    Every map task writes one block per reducer, so map tasks x reducers
    decides both the shuffle bookkeeping and the block size: sizing reducers
    by the *input* (100 TB in 256 MB pieces is ~400k reducers against ~400k
    map tasks, ~10^11 blocks of a few hundred bytes) would drown the job in
    tiny fetches.  So the reducer count follows the largest *shuffle* (after
    projection and map-side combine) at the target size, bounded below by
    two and above by ``max_waves`` waves of cores; scan splits are larger
    than the target to cut the number of map tasks.  AQE then coalesces
    small shuffle partitions to the advisory size (not to the core count,
    so a shared cluster is not flooded with tiny tasks; contiguous reducer
    ranges are fetched in batches) and splits skewed ones."""
    need = -(-largest_shuffle_bytes // target_partition_bytes)
    parts = min(max(2 * total_cores, need), max_waves * total_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }


def get_session(app: str = "tripwise", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_sql_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (e.g. one the
    caller built).  Static settings such as the UI are left alone."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static or locked config
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root the cluster names in
    ``spark.checkpoint.dir``.  Only a local session that has none (tests)
    gets a private directory; on a cluster that would be a folder of the
    driver's machine which executors do not see, so it is an error."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    existing = sc.getCheckpointDir()
    if existing:
        # getCheckpointDir() appends a per-application subfolder
        return existing.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="tripwise-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint root for written
    intermediate tables (sinks, stream checkpoints)."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/tripwise-scratch/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a file: scheme for the few places that need an OS path."""
    return path[len("file:"):] if path.startswith("file:") else path
