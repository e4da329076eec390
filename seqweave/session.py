"""Session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "seqweave") -> SparkSession:
    """Return the active session, or build a local one for tests and benches.

    On a cluster the session already exists (spark-submit); this only fills in
    settings that are unset.  AQE stays on so shuffles of small plan tables are
    coalesced and skewed joins are split at run time.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cpus = os.cpu_count() or 8
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local runs work on small tables whose rows expand a lot after a
        # shuffle (text -> token arrays): keep several tasks busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                os.environ.get("SEQWEAVE_MIN_PARTITION", "64k"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def _is_local_master(spark: SparkSession, sc) -> bool:
    if sc is not None:
        return sc.master.startswith("local")
    try:
        return str(spark.conf.get("spark.master", "")).startswith("local")
    except Exception:  # noqa: BLE001 - a session that does not say is a cluster's
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    The cluster's setting always wins.  Only when nothing is configured and
    the master is local (tests) a private folder is created and registered,
    so that ``checkpoint()`` and staged tables work the same way everywhere.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not conf:
        try:
            conf = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf = None
    if not conf:
        if not _is_local_master(spark, sc):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(staged tables and checkpoints must survive executor loss)")
        conf = tempfile.mkdtemp(prefix="seqweave-ckpt-")
    if sc is None:
        return conf
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``seqweave`` importable in Python workers (like ``--py-files``).

    Steps that run Python on executors (the plan walk, the pretrained
    tokenizer, the Arrow sink) call this first.  The package is zipped once
    on the driver and distributed by Spark (``addPyFile``, or artifacts for a
    Spark Connect session).  Set ``spark.seqweave.shipPackage=false`` when
    the package is installed on the workers.
    """
    import zipfile

    sc = _context(spark)
    app = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    if str(spark.conf.get("spark.seqweave.shipPackage", "true")).lower() == "false":
        _SHIPPED.add(app)
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="seqweave-pyfiles-"), "seqweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, dirnames, filenames in os.walk(pkg_dir):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for name in filenames:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)
