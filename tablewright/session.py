"""Session defaults, the shared work folder, and table-backed lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_swept: set[str] = set()
_shipped: set[str] = set()


def get_session(app: str = "tablewright", cores: int | None = None) -> SparkSession:
    """A session with the settings this library is tuned for.

    ``cores`` asks for a local session; without it the master, the memory and the
    number of shuffle partitions come from ``spark-submit``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.driver.memory", "8g")
            .config("spark.sql.shuffle.partitions", str(cores))
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tablewright-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, unique to this application and call.

    The application's folder is deleted when its driver exits.
    """
    app = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark)}/tablewright/{app}"
    if app not in _swept:
        _swept.add(app)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, task_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives Catalyst the
    true size of the table, so it broadcasts the table only if it really is small.
    With ``task_rows``, no task that reads the table gets more rows than that, however few bytes they take.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if task_rows is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    df.write.option("maxRecordsPerFile", task_rows).parquet(path)
    return file_by_file(spark).read.schema(df.schema).parquet(path)


def file_by_file(spark: SparkSession) -> SparkSession:
    """A session whose tasks read one file each, however few bytes it has.

    Spark deals files to tasks by their bytes.  Where opening a file counts as much as a task may read, each task
    gets one file; that setting belongs to a session.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    return own


def discard(df: DataFrame) -> None:
    """Delete the written table behind a frame from :func:`materialize` before the driver exits."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if "/tablewright/" not in path.toString():
            raise ValueError(f"{path} is no scratch table")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def share_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application.

    Workers then import it without being started from its folder. The archive is made on the driver, and
    Spark hands it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tablewright-source-")
    path = os.path.join(folder, "tablewright-source.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for place, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(place, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(root)))
    context.addPyFile(path)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a scan by ``keys`` when its files split into too few tasks.

    A table of many files or row groups comes back untouched.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, *keys)
