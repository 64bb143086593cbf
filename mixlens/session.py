"""Session helpers: a local session for tests/bench, and shared scratch paths.

On a cluster the caller owns the session; the library only reads from it.
Scratch output (CSV/Parquet round trips, model directories, lineage cuts)
goes under the shared folder named by ``spark.checkpoint.dir``. Only when
that setting is absent (local tests) do we pick a folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; applied by ``local_session`` and suggested
# for cluster jobs. AQE coalesces small shuffle partitions, splits skewed
# sort-merge-join partitions and turns joins whose runtime side is small into
# broadcast joins.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Fall back from whole-stage code generation when a fused method would be
    # too large for the JVM's JIT (8000 bytes); such a method would otherwise
    # run interpreted. Matters for the unrolled composition projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "mixlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session with the settings used by tests and bench."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g")
               # Local runs only: tables saved by tests/bench go to a temp folder.
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="mixlens-wh-")))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local"):
        # Local runs only (tests, bench): one machine, so a temp folder is shared.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="mixlens-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                           "(HDFS/S3/ABFS); mixlens writes scratch tables and checkpoints there")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    All scratch data of an application lies in one folder, which its driver deletes
    when it ends (results may read it lazily until then).
    """
    sc = spark.sparkContext
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/mixlens/{sc.applicationId}"
    folder = sc._jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
