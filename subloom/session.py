"""Session helpers: local sessions, table access and the shared folder for cut lineages."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "subloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests, the command line and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Gives this package to the Python workers, once an application, wherever the driver has it from."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parent
        if root.is_dir():  # else the driver itself runs from such an archive
            target = Path(tempfile.mkdtemp(prefix="subloom-code-")) / "subloom.zip"
            with zipfile.ZipFile(target, "w") as z:
                for p in sorted(root.rglob("*.py")):
                    z.write(p, p.relative_to(root.parent))
            context.addPyFile(str(target))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where that is unset, a new temporary one is set (as in tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="subloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """checkpoint() into the shared folder: fixes partitions and their order, and survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write to a table in the shared folder and read it back; readers then prune columns. Removed at exit."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass
