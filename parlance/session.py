"""Session helpers: table access, shared scratch space, schema guards."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()
_RUN = uuid.uuid4().hex[:12]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only where that is unset (tests, local mode)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_SCRATCH:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="parlance-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _OWN_SCRATCH[app] = f"file://{path}"
    return _OWN_SCRATCH[app]


def _own_folder(spark: SparkSession) -> str:
    """Of this application and no other: process ids may be equal in containers."""
    return f"parlance-{spark.sparkContext.applicationId}-{_RUN}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage like a reliable checkpoint, but columnar, compressed and computed once. The files survive the loss
    of any executor. They live in a folder of their own under ``spark.checkpoint.dir`` and are removed with it, or by
    :func:`release`.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lasting_folder(spark: SparkSession, name: str) -> str:
    """Where a table is kept from run to run: under ``parlance.store.dir`` if that is set, else in a new scratch folder."""
    store = spark.conf.get("parlance.store.dir", None)
    return f"{store.rstrip('/')}/{name}" if store else f"{scratch_root(spark)}/{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete the tables that this application materialized."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{_own_folder(spark)}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once for each application, so that Python code runs there without an installation."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    package = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="parlance-code-")  # Spark's file server takes it from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/parlance_code.zip", "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(f"{folder}/parlance_code.zip")


def tasks_for(df: DataFrame, bytes_per_task: int = 4 << 20) -> int:
    """A number of tasks from the size that the optimizer knows of the input files; at least the default parallelism."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, min(200_000, size // bytes_per_task))
