"""Session helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, name: str = "ledgerloom") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: spark.checkpoint.dir where the cluster names one.

    Only where it is unset and the master is local (single-machine tests) a temporary folder is
    made; on a cluster it must be set, as a folder of one machine would be lost with it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        named = "file://" + tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


#: Makes Spark drop the shuffle files of a plan as soon as it is executed.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written to the shared folder and lineage is cut.

    A checkpoint keeps the estimated size and the constraints of the plan it replaces. In loops
    with joins these estimates are multiplied round by round, to numbers of millions of digits that
    fill the driver, so the rows are taken up as a new relation of unknown size; the adaptive
    planner sees the real one. The shuffle files of the plan are dropped at once, as nothing reads
    them again; else they stay on disk until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        done = df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(_CLEAN, before) if before is not None else spark.conf.unset(_CLEAN)
    plan = done._jdf.queryExecution()
    out = DataFrame(spark._jsparkSession.internalCreateDataFrame(plan.toRdd(), done._jdf.schema(), False), spark)
    out._checkpoint = plan.logical().rdd().getCheckpointFile()
    return out


def release(*dfs: DataFrame) -> None:
    """Deletes checkpoints that no later plan reads: what was made from them must be checkpointed itself."""
    for df in dfs:
        sc = df.sparkSession.sparkContext
        if df._checkpoint.isDefined():
            path = sc._jvm.org.apache.hadoop.fs.Path(df._checkpoint.get())
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers once per application, so that executors need no installation."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    here = os.path.dirname(os.path.abspath(__file__))
    to = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-"), "ledgerloom.zip")
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("ledgerloom", os.path.relpath(path, here)))
    sc.addPyFile(to)  # Spark copies it to every executor


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a scale directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
