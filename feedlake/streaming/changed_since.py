"""Changed-since reads as a stream whose offset is the watermark.

The Python source is only the clock: per micro-batch it emits one row, the half-open interval of
change times to read. The rows themselves come from a native scan inside ``foreachBatch``, with the
interval pushed down to the files.

Intervals are noted beside the rows: opened before rows are written, closed after. A batch that failed half-way is run
again for its own interval and into its own folder, and the next one goes on where the last closed one ended, also
where the stream starts again with another checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..errors import ReadError
from ..functions.dates import watermark_text
from ..operators.incremental import changed_since
from ..session import ship_package
from ..sources.versions import Versions

_LEDGER = "_intervals"
_INTERVAL = T.StructType([T.StructField("since", T.StringType()), T.StructField("until", T.StringType())])


class _Interval(InputPartition):
    def __init__(self, since: str | None, until: str) -> None:
        self.since = since
        self.until = until


class WatermarkClock(DataSource):
    """Options: ``since`` (first watermark; none reads everything) and ``until`` (default: now)."""

    @classmethod
    def name(cls) -> str:
        return "feedlake_watermark"

    def schema(self) -> T.StructType:
        return _INTERVAL

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _ClockReader(self.options.get("since"), self.options.get("until"))


class _ClockReader(DataSourceStreamReader):
    def __init__(self, since: str | None, until: str | None) -> None:
        self._since = since
        self._until = until

    def initialOffset(self) -> dict:
        return {"watermark": self._since}

    def latestOffset(self) -> dict:
        return {"watermark": self._until or watermark_text(dt.datetime.now(dt.timezone.utc))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Interval(start["watermark"], end["watermark"])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield (partition.since, partition.until)


def stream_changes(
    spark: SparkSession,
    load: Callable[[], DataFrame],
    column: str,
    out: str,
    checkpoint: str,
    since: str | None = None,
    until: str | None = None,
) -> StreamingQuery:
    """Land the rows of ``load()`` changed since the last run below ``out``, and stop when caught up.

    The first run, without ``since``, reads everything, rows without a change time included. Start it again with the same
    ``checkpoint``, or with the same ``out`` alone, to go on from the last interval. :func:`read_changes` reads the rows.
    """
    ship_package(spark)
    spark.dataSource.register(WatermarkClock)
    clock = spark.readStream.format(WatermarkClock.name())
    for name, value in (("since", since), ("until", until)):
        clock = clock if value is None else clock.option(name, value)
    ledger = Versions(spark, f"{out}/{_LEDGER}")

    def fill(number: int, interval: dict) -> None:
        rows = changed_since(load(), column, interval["since"], interval["until"])
        rows.write.mode("overwrite").parquet(f"{out}/{interval['folder']}")
        ledger.publish(number + 1, {**interval, "closed": True})

    def land(intervals: DataFrame, batch_id: int) -> None:
        span = intervals.first()
        if span is None:
            return
        number, last = ledger.latest()
        if last and not last["closed"]:
            fill(number, last)
            number += 1
        begin = last["until"] if last else span["since"]
        if begin is None or begin < span["until"]:  # else this batch has been closed already
            interval = {"since": begin, "until": span["until"], "folder": f"interval={number + 1:012d}", "closed": False}
            if not ledger.publish(number + 1, interval):
                raise ReadError("another stream writes to the same folder", path=out)
            fill(number + 1, interval)

    writer = clock.load().writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_changes(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The rows of the closed intervals below ``out``."""
    closed = [content["folder"] for _, content in Versions(spark, f"{out}/{_LEDGER}").history() if content["closed"]]
    if not closed:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{out}/{folder}" for folder in closed])
