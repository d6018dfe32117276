"""Session defaults. On a cluster the submit-time configuration wins over these."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The JVM does not optimize methods beyond 8,000 bytes of bytecode; wide score and classification
# projections exceed that when a whole stage is one method, and then run several times slower.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
DENSE = "zstd"  # codec of large stored tables: ids and urls take about half of what they take under the default one


def tune(spark: SparkSession) -> SparkSession:
    """Apply those of the settings above that the session does not set itself."""
    given = dict(spark.sparkContext.getConf().getAll()) | dict(spark.conf.getAll)
    for key, value in DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "shelfmark", **conf: str) -> SparkSession:
    """A local session for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(cores),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. A local session without one gets a temporary folder; a
    cluster must name one, since executors do not see each other's disks."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="shelfmark-")
        context.setCheckpointDir(folder)
        current = context.getCheckpointDir()
    return current


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: later readers repeat none of its work, take only
    the columns they use, and do not depend on executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go when it ends, and not when the driver's JVM next collects garbage: a job of many
    steps then holds those of one step. Each step should store its rows, as a frame that is run again shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_checkpoints(df: DataFrame) -> None:
    """Delete the checkpoints that ``df`` reads, once nothing needs them any more. Spark does so only where it is told to, and
    then when the driver's JVM collects garbage."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        file = leaf.rdd().getCheckpointFile() if leaf.getClass().getSimpleName() == "LogicalRDD" else None
        if file is not None and file.isDefined():
            name = spark._jvm.org.apache.hadoop.fs.Path(file.get())
            name.getFileSystem(spark._jsc.hadoopConfiguration()).delete(name, True)
