"""The frames that queries share over one folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import facts, status
from ..sources import notes, store

#: The day that "today" stands for: results depend on it, not on the clock.
AS_OF = date(2024, 1, 31)


#: Where the facts of an application, a day and tables of a state are written.
_WRITTEN: dict[tuple, str] = {}


class Warehouse:
    """Base tables, facts, tags and status of a folder.

    The first use of the facts writes them to the shared folder, by year of the action; all marts read those files, each only its
    columns. Tables that were written anew since are another state, and their facts are written again.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: date = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def base(self) -> notes.Base:
        return notes.tables(self.spark, self.sf_dir)

    @cached_property
    def facts(self) -> DataFrame:
        state = [store.state(self.spark, f"{self.sf_dir}/{t}.parquet") for t in ("events", "documents", "nation")]
        key = (self.spark.sparkContext.applicationId, self.sf_dir, *state)
        if key not in _WRITTEN:
            path = store.folder(self.spark, "facts")
            with store.lean(self.spark):
                facts.write(facts.facts(notes.snapshot(self.base)), path)
            _WRITTEN[key] = path
        return self.spark.read.parquet(_WRITTEN[key]).drop("action_year")

    def bodies(self, rows: DataFrame, seqs: dict[str, str], shape: Callable[[Column], Column]) -> DataFrame:
        """Rows of notes with shaped bodies of their actions, which the facts don't hold."""
        return notes.with_bodies(self.spark, self.sf_dir, rows, seqs, shape)

    @cached_property
    def tags(self) -> DataFrame:
        return facts.tags(self.facts)

    @cached_property
    def status(self) -> DataFrame:
        return status.current(self.facts)
