"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC instants, ANSI errors surfaced, runtime
# re-planning (coalesce small shuffles, split skewed join partitions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # CPU-heavy per-row stages (regex folds, parsing) follow small shuffles;
    # do not merge those below 256 KB per task (large inputs are unaffected).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # From planner estimates only very small sides are broadcast (estimates
    # can be far off after generators); larger ones when measured at runtime.
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the HTML and feed stages ship whole documents to Python: bound each
    # Arrow batch by bytes as well as rows, so what a worker holds does not
    # grow with its partition
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "feedloom", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedloom`` importable in executor Python workers (the Arrow
    HTML stage pickles its functions by module reference).  The package is
    zipped once per SparkContext and added with ``addPyFile``; Spark's file
    server hands it to every executor, including ones started later."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("feedloom", os.path.relpath(full, pkg)))
    out = os.path.join(tempfile.mkdtemp(prefix="feedloom-py-"), "feedloom.zip")
    with open(out, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(out)
    _SHIPPED.add(app)


def apply_conf(spark: SparkSession) -> None:
    """Pin the SQL settings on a session someone else built."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always read from
    the session.  Only when it is unset and the master is local do we pick a
    scratch folder of our own, which goes when the process ends.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="feedloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core setting may be read-only on some deployments
            pass
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
