"""The log of mart updates: each leaves a row with its times, rows and errors, measured while it runs."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.layers import put_text

_LOG = "log_id long, kind string, entity_id long, start_time timestamp_ntz, duration double, records long, facts long, status string, error string"


class Update:
    """An update that runs; what is written through `rows` and read through `facts` is counted as it goes by."""

    def __init__(self, kind: str, entity_id: int | None):
        self.kind, self.entity_id = kind, entity_id
        self._seen: dict[str, list[Observation]] = {"records": [], "facts": []}

    def rows(self, df: DataFrame) -> DataFrame:
        """The frame, whose rows count as the update's records when it is written."""
        return self._counted(df, "records")

    def facts(self, df: DataFrame) -> DataFrame:
        """The frame, whose rows count as facts that the update reads."""
        return self._counted(df, "facts")

    def count(self, name: str) -> int:
        return sum(o.get["n"] for o in self._seen[name])

    def _counted(self, df: DataFrame, name: str) -> DataFrame:
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        self._seen[name].append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("n"))


class UpdateLog:
    """Log rows in files of a folder, one for each update, which is there whether it succeeds or fails."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @contextmanager
    def update(self, kind: str, entity_id: int | None = None) -> Iterator[Update]:
        """Run an update: `with log.update("countries") as u: u.rows(df).write...`. An error is logged and goes on."""
        run, start, began = Update(kind, entity_id), datetime.now(UTC).replace(tzinfo=None), time.monotonic()
        try:
            yield run
        except Exception as e:
            self._put(run, start, time.monotonic() - began, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500])
            raise
        self._put(run, start, time.monotonic() - began, None)

    def read(self) -> DataFrame:
        """The rows, as the analyses of operators.checks take them."""
        return self.spark.read.schema(_LOG).json(self.path)

    def _put(self, run: Update, start: datetime, duration: float, error: str | None) -> None:
        ok = error is None  # the counts of a failed update's writes never come
        row = {"log_id": time.time_ns(), "kind": run.kind, "entity_id": run.entity_id, "start_time": start.isoformat(), "duration": duration, "records": run.count("records") if ok else 0, "facts": run.count("facts") if ok else 0, "status": "success" if ok else "error", "error": error}
        put_text(self.spark, f"{self.path}/{row['log_id']}-{uuid.uuid4().hex}.json", json.dumps(row))
