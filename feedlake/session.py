"""Session settings, the shared scratch folder and size-checked broadcasts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Row bound for a broadcast side. The sides measured here are narrow (a key plus a few numbers or
# short strings, under 1 KB a row), so the bound keeps a broadcast below about 100 MB.
BROADCAST_ROWS = 100_000
#: Narrow rows for which ``in_few_tasks`` allows a task.
TASK_ROWS = 20_000


def build_session(app: str = "feedlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for; ``conf`` overrides or adds."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="feedlake-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def landed(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back, for plans that read it several times."""
    folder = scratch_dir(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def in_few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a table of at most ``rows`` narrow rows, in no more tasks than it needs: one per TASK_ROWS, but two per core.

    For small tables behind a shuffle, each of whose partitions would else be a file of a few rows, and on a local disk a few
    processes that set its permissions. No row is shuffled for it; a table of many rows keeps the tasks it has.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which nulls are equal; the key columns of ``left`` stay."""
    other = right.select([F.col(c).alias(f"_key_{c}" if c in keys else c) for c in right.columns])
    same = [left[c].eqNullSafe(other[f"_key_{c}"]) for c in keys]
    return left.join(other, same, how).drop(*[f"_key_{c}" for c in keys])


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="feedlake-ship-")) / package.name
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def sized(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if counting proves it has at most ``max_rows`` rows.

    A larger side is returned as it is, and the join shuffles (with AQE splitting skewed keys). The
    count stops at the bound.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
