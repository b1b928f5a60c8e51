"""Session construction, table access and shared-folder tables.

Everything that must outlive one plan (loop states, tables read twice) is
written as Parquet under the folder named by ``spark.checkpoint.dir`` so that
losing an executor never loses it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "netsounder") -> SparkSession:
    """A session for one machine; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("NETSOUNDER_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read only through Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share; an own one only where none is set."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="netsounder-")
        context.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/netsounder/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._netsounder_path = path
    return out


def counted(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """:func:`stored` and its number of rows, told by the write itself."""
    seen = Observation()
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]


def together(parts: list[DataFrame]) -> DataFrame:
    """Several stored tables of one schema as a single scan."""
    return parts[0].sparkSession.read.schema(parts[0].schema).parquet(*[p._netsounder_path for p in parts])


def discard(df: DataFrame) -> None:
    """Delete what :func:`stored` wrote, once no later plan reads it."""
    path = getattr(df, "_netsounder_path", None)
    if path is None:
        return
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path).getParent()
    target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
