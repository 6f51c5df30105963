"""Session settings and the shared working folder.

Every entry point calls :func:`configure` on the session it is given, so the
engine behaves the same whether it owns the session (tests, bench) or runs
inside a session somebody else built (a cluster job, the driver's checker).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the engine relies on. They are all session-scoped and
# safe to set on a shared session.
RUNTIME_CONF = {
    # One clock for every date/hour derivation.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce tiny shuffle partitions, split skewed
    # join partitions, turn a shuffle join into a broadcast once the real
    # size of one side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "revcast",
) -> SparkSession:
    """Session for tests and the benchmark. Cluster jobs get theirs from
    spark-submit and only call :func:`configure`."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Root folder for tables, checkpoints and stream state.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``.
    Only a local session without that setting (tests, the bench, the driver's
    smoke check) gets a fresh folder of its own under the system temp dir.
    """
    sc = spark.sparkContext
    known = _ROOTS.get(sc.applicationId)
    if known:
        return known
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - conf lookup refused
            configured = None
    if configured:
        root = configured.rstrip("/")
    elif sc.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="revcast-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    else:
        raise RuntimeError(
            "spark.checkpoint.dir must name a shared folder on a cluster; "
            "the engine writes tables and stream state there"
        )
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{root}/_checkpoints")
    _ROOTS[sc.applicationId] = root
    return root


_ROOTS: dict[int, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
