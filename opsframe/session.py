"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Epoch functions read zone-less timestamps as UTC; JSON objects with a
# repeated key keep the last value instead of being rejected; a hot join key is
# split even where that costs one more shuffle afterwards.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it.

    They hold for the whole session. Splitting a hot join key even where that
    costs another shuffle (``forceOptimizeSkewedJoin``) is worth it for keyed
    writes on skewed keys; a session without those may turn it off again.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(
    app_name: str = "opsframe",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or fetch a configured session.

    Executor counts, memory and shuffle partitions belong to the cluster's
    own defaults; pass them in ``conf`` only to override those.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    Taken from ``spark.checkpoint.dir``. A machine-local folder is used only
    by a local master with that setting unset.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by all executors"
        )
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="opsframe-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the scratch folder; never reused."""
    return f"{scratch_root(spark)}/opsframe-{label}-{uuid.uuid4().hex}"
