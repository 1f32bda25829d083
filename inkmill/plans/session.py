"""Session helpers: tables, settings of the Arrow exchange, and cut lineage in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of long texts that go to a Python worker at once; keeps a worker's batch at some MB.
ARROW_ROWS = 256


def tune(spark: SparkSession) -> SparkSession:
    """Settings that every query of this package relies on; all of them may be changed at run time."""
    for key, value in (
        ("spark.sql.session.timeZone", "UTC"),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS)),
        ("spark.sql.adaptive.enabled", "true"),
        ("spark.sql.adaptive.skewJoin.enabled", "true"),
    ):
        spark.conf.set(key, value)
    return spark


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.

    Where it is unset and Spark runs in one process, as in tests, a temporary folder is made and kept
    for the session. On a cluster an unset folder is an error, as a machine's own folder can't be shared.
    """
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", "") or conf.get("spark.checkpoint.dir") or spark.conf.get("inkmill.shared.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="inkmill-")
        spark.conf.set("inkmill.shared.dir", folder)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


#: Tables that were written and not yet released, by application.
_KEPT: dict[str, list[str]] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here, and lost executors
    cost no recomputation of what came before.

    The job runs when this is called, so operators that use it do part of their work while their plan is built. The
    tables stay until ``release``: a result can be read again for as long as it is wanted."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/inkmill/{name}-{uuid.uuid4().hex}"
    _KEPT.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Deletes all tables that ``written`` has left in this session, and gives their number. To be called when the results were
    stored, in any case after work on personal data: its tables hold what was found and the texts it was found in."""
    paths = _KEPT.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def bounded(df: DataFrame, most: int, what: str) -> list:
    """The rows of a small table of settings; more than ``most`` rows are an error, so that nothing
    that grows with the data is ever sent to the driver."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what} has more than {most} rows")
    return rows
