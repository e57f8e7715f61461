"""Changes of a versioned table, consumed step by step by named cursors that survive restarts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltlake.operators import dml
from siltlake.operators.cdc import changes
from siltlake.operators.changelog import COMMIT_SCHEMA, load, resolve
from siltlake.session import delete_path

_SCHEMA = "seq long, low long, high long, done boolean"

#: Gets change rows and the versions they lie between.
Handler = Callable[[DataFrame, int, int], object]


class Cursor:
    """Where a consumer stands in the versions of a table; kept below the table, so that expiry waits for it.

    A step is written down before its changes are handed out and again when they are handled. One
    that was lost in between is handed out again between the same versions, so a handler that is
    repeatable between two versions (a merge by key, an append named by the version) has each change
    applied once. Versions that only moved data give no rows.
    """

    def __init__(self, spark: SparkSession, base: str, name: str) -> None:
        self.spark, self.base, self.name, self.path = spark, base, name, f"{base}/cursors/{name}"

    def _read(self):
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.path).orderBy(F.desc("seq")).first()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _put(self, low: int, high: int, done: bool) -> None:
        """The new row is complete before the one it replaces goes."""
        last, old = self._read(), []
        if last is not None:
            old = [r.file_path for r in self.spark.read.schema(_SCHEMA).parquet(self.path).select("_metadata.file_path").distinct().collect()]
        row = [(last.seq + 1 if last else 1, low, high, done)]
        self.spark.createDataFrame(row, _SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        for path in old:
            delete_path(self.spark, path)

    def open(self, version: int | None = None) -> int:
        """Stand at a version, by default the current one; a cursor that exists stays where it is."""
        last = self._read()
        if last is None:
            start = resolve(load(self.spark, self.base), version).version
            self._put(start, start, True)
            return start
        return last.high if last.done else last.low

    def position(self) -> int:
        """The newest version whose changes have all been handled."""
        last = self._read()
        if last is None:
            raise ValueError(f"no cursor {self.name}")
        return last.high if last.done else last.low

    def advance(self, handle: Handler) -> bool:
        """Hand out the changes up to the current version; False if there are no new versions."""
        last = self._read()
        if last is None:
            raise ValueError(f"no cursor {self.name}")
        low, high = last.low, last.high
        if last.done:
            low, high = last.high, resolve(load(self.spark, self.base)).version
            if low == high:
                return False
            self._put(low, high, False)
        handle(changes(self.spark, self.base, low, high, as_newest=True), low, high)
        self._put(low, high, True)
        return True

    def close(self) -> None:
        """Forget the cursor; expiry no longer waits for it."""
        delete_path(self.spark, self.path)


def follow(
    cursor: Cursor, handle: Handler, checkpoint: str, once: bool = True, trigger: str = "1 minute"
) -> StreamingQuery:
    """Run a cursor whenever the table has new commits: a stream over them wakes it up.

    What the stream reads only says that there is something; the cursor knows what. So commits
    that were folded into another file in the meantime are no loss.
    """
    def step(_: DataFrame, __: int) -> None:
        cursor.advance(handle)

    woken = cursor.spark.readStream.schema(COMMIT_SCHEMA).option("ignoreMissingFiles", "true").parquet(f"{cursor.base}/commits")
    kind = {"availableNow": True} if once else {"processingTime": trigger}
    return woken.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**kind).start()


def replicate(spark: SparkSession, target: str, key: Sequence[str]) -> Handler:
    """A handler that merges changes into another versioned table, which is created with the first step."""
    def handle(changed: DataFrame, low: int, high: int) -> None:
        columns = changed.schema["after"].dataType.names
        rows = changed.select(
            *[F.coalesce(F.col(f"after.`{c}`"), F.col(f"before.`{c}`") if c in key else F.lit(None)).alias(c) for c in columns],
            (F.col("change") == "delete").alias("_gone"))
        if not load(spark, target):
            dml.create_or_replace(rows.where("not _gone").drop("_gone"), target, key)
            return
        cells = {c: F.col(f"s.`{c}`") for c in columns if c not in key}
        dml.merge(spark, target, rows, key, cells, F.col("s._gone"), {**cells})

    return handle
