"""Session and shared-storage helpers used by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, app: str = "korvane") -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    cores = os.environ.get("BENCH_CPUS", cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "10g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


#: Most rows and bytes of a batch that goes to a Python worker; an application that sets either keeps its own.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def ship_code(spark: SparkSession) -> None:
    """Makes an application ready, once: this package goes to the executors, so that their Python workers can import it.

    Texts can be long, and a batch is held by the JVM and by Python at once, so batches are
    bounded by BATCH too, unless the application has set a bound itself.
    """
    done = getattr(ship_code, "done", None)
    if done == (app := spark.sparkContext.applicationId):
        return
    ship_code.done = app
    for name, most in BATCH.items():
        if spark.sparkContext.getConf().get(name, None) is None and spark.conf.get(name) == _defaults(spark, name):
            spark.conf.set(name, most)
    top = Path(__file__).resolve().parent
    path = f"{tempfile.mkdtemp(prefix='korvane-code-')}/korvane.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(path)


def _defaults(spark: SparkSession, name: str) -> str:
    """The value of a setting in a session that has set nothing."""
    return spark.newSession().conf.get(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where the setting is absent (tests, one machine) a temporary folder
    is made; on a cluster the setting must be there.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(shared_dir, "own", None)
    if own is None:
        own = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="korvane-")
    return own


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's cuts, within the shared one."""
    return f"{shared_dir(spark)}/korvane-{spark.sparkContext.applicationId}"


def cut(df: DataFrame, name: str = "cut", to: DataFrame | None = None) -> DataFrame:
    """df written once to the shared folder and read again: its lineage ends there.

    With `to`, an earlier cut of the same columns, the rows are added to its files; the frame returned has all, and takes its place.
    """
    spark = df.sparkSession
    ship_code(spark)
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}" if to is None else to.cut_path
    df.write.mode("error" if to is None else "append").parquet(path)
    got = spark.read.schema(df.schema).parquet(path)
    got.cut_path = path
    for scope in _scopes:
        scope[:] = [x for x in scope if x is not to]
    if _scopes:
        _scopes[-1].append(got)
    return got


_scopes: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Within it, cuts are for the time being: at its end all are deleted but those given to the function it yields.

    What outlives it must not read the others.
    """
    own: list[DataFrame] = []
    _scopes.append(own)

    def keep(df: DataFrame) -> DataFrame:
        own[:] = [x for x in own if x is not df]
        if len(_scopes) > 1:
            _scopes[-2].append(df)
        return df

    try:
        yield keep
    finally:
        _scopes[:] = [x for x in _scopes if x is not own]
        release(*own)


def few(df: DataFrame, most: int = 100_000) -> bool:
    """Whether a table has at most so many rows and may be broadcast."""
    return df.limit(most + 1).count() <= most


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(*cuts: DataFrame) -> None:
    """Deletes the files of cuts that nothing will read again; frames that are no cuts are left alone."""
    for df in cuts:
        if path := getattr(df, "cut_path", None):
            _delete(df.sparkSession, path)


def clean_up(spark: SparkSession) -> None:
    """Deletes all cuts of this application: to be called when its results are written."""
    _delete(spark, run_dir(spark))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Columns by exact name, safe where other columns differ only by case."""
    ship_code(df.sparkSession)
    own = list(df.columns)
    flat = df.toDF(*[f"__c{i}" for i in range(len(own))])
    return flat.select(*[F.col(f"__c{own.index(n)}").alias(n) for n in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
