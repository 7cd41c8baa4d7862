"""Session handling: one session, passed in; the master always comes from outside."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# The full outer joins deal with hot keys themselves (operators/joins.py). Other joins
# and the rebalanced writes count on runtime re-planning, which is therefore set here,
# though it is Spark's default. The last setting lets it see a hot partition also
# beyond 2,000 shuffle partitions, where Spark otherwise reports average sizes.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.shuffle.accurateBlockSkewedFactor": "5",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def get_session(app_name: str = "starmart", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder for written intermediates, one per call.

    On a cluster it lies under the shared folder named in ``spark.checkpoint.dir``,
    because every executor must see it and it must outlive any of them. A machine
    local folder is used only in local mode, where that setting may be unset.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return f"{shared.rstrip('/')}/starmart-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return tempfile.mkdtemp(prefix="starmart-")
