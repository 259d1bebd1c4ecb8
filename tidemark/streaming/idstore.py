"""The ids that a stream has landed, in few files however long it runs.

Every micro-batch adds a run: its ids, sorted by event day and id.  Each time
``FAN`` runs of a level are there they are merged into one of the next, so
after n micro-batches there are at most ``FAN - 1`` runs on each of
log(n) / log(FAN) levels, an id is rewritten once a level, and a look-up opens
these runs only.  Which runs exist follows from the number of micro-batches
alone (its digits to the base ``FAN``), so there is nothing to list and no
catalogue to keep, and a replayed micro-batch finds what it found before:
what a merge replaced is removed when the micro-batch after it begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

IDS_SCHEMA = "event_id string, event_day string"
FAN = 8

Run = tuple[int, int]  # level, first micro-batch


def runs_before(number: int, fan: int = FAN) -> list[Run]:
    """The runs that hold the micro-batches 0 .. number - 1, oldest first."""
    level, out, at = 0, [], 0
    while fan ** (level + 1) <= number:
        level += 1
    for k in range(level, -1, -1):
        for _ in range(number // fan ** k % fan):
            out.append((k, at))
            at += fan ** k
    return out


def replaced_by(number: int, fan: int = FAN) -> list[Run]:
    """The runs that are merged when micro-batch ``number`` ends; empty if none are."""
    after = set(runs_before(number + 1, fan))
    return [r for r in [*runs_before(number, fan), (0, number)] if r not in after]


class LandedIds:
    """The runs of one query under ``root``."""

    def __init__(self, spark: SparkSession, root: str, fan: int = FAN):
        self.spark, self.root, self.fan = spark, root, fan

    def _path(self, run: Run) -> str:
        return f"{self.root}/level={run[0]}/run={run[1]}"

    def _read(self, runs: list[Run]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], IDS_SCHEMA)
        return self.spark.read.schema(IDS_SCHEMA).parquet(*map(self._path, runs))

    def _write(self, ids: DataFrame, run: Run) -> None:
        (ids.hint("rebalance", "event_day").sortWithinPartitions("event_day", "event_id")
         .write.mode("overwrite").parquet(self._path(run)))

    def before(self, number: int) -> DataFrame:
        """Ids that the micro-batches before ``number`` have landed."""
        return self._read(runs_before(number, self.fan))

    def add(self, ids: DataFrame, number: int) -> None:
        """Keep the ids of micro-batch ``number``; the same again if it is replayed."""
        if number:  # the one before is committed: what its merge replaced is not needed any more
            self._remove(replaced_by(number - 1, self.fan))
        self._write(ids.select("event_id", "event_day"), (0, number))
        old = replaced_by(number, self.fan)
        if old:
            self._write(self._read(old), runs_before(number + 1, self.fan)[-1])

    def _remove(self, runs: list[Run]) -> None:
        for r in runs:
            files.remove(self.spark, self._path(r))


def first_time(decoded: DataFrame, landed: DataFrame, delay: str, day_of) -> DataFrame:
    """The events of a micro-batch, with their ``event_day``, that are not among
    the ``landed`` ids of the days within ``delay`` of them; one row per id."""
    at = day_of(F.col("timestamp"))
    once = (decoded.groupBy("event_id").agg(F.min(F.struct(*decoded.columns)).alias("e")).select("e.*")
            .withColumn("event_day", at.cast("date").cast("string")))
    step = F.expr(f"INTERVAL '{delay}'")
    near = once.select("event_id", F.explode(F.sequence((at - step).cast("date"), (at + step).cast("date")).cast("array<string>"))
                       .alias("event_day"))
    # two values reach the driver; the runs are sorted by day, so files outside are skipped
    first, last = near.agg(F.min("event_day"), F.max("event_day")).first()
    there = landed.where(F.col("event_day").between(first, last)) if first else landed.limit(0)
    again = near.join(there, ["event_id", "event_day"], "left_semi").select("event_id")
    return once.join(again, "event_id", "left_anti")
