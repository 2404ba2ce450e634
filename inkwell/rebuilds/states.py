"""Tables of states that a run extends by its days instead of reading all days again.

A bundle keeps, beside its current tables, the same tables as of a closed day: the last one that no later
run will change any more. A run first moves the closed tables up to its own closed day, and then puts the
days of its window on top of them. So it reads one state per key and the days that came in since, however
long the history is, and late rows or a day that vanished from the window cost nothing extra, because
the closed tables never held them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from inkwell.rebuilds.incremental import overwrite

Tables = Mapping[str, DataFrame]
Keep = Callable[[DataFrame, str], DataFrame]


def as_it_is(rows: DataFrame, name: str) -> DataFrame:
    """A plan that is not stored in between."""
    return rows


@dataclass(frozen=True)
class Bundle:
    """Tables of states, the tables with days that they fold, and how they advance by some days.

    ``advance`` takes the tables so far (None: nothing yet), rows of the tables with days, and a function
    that stores what several of the new tables are made from.
    """

    tables: tuple[str, ...]
    days: tuple[str, ...]
    advance: Callable[[Tables | None, Tables, Keep], Tables]


class ClosedStates:
    """The closed tables of a bundle below a folder, by the day that they end with."""

    def __init__(self, spark: SparkSession, folder: str, bundle: Bundle):
        self.spark, self.folder, self.bundle = spark, folder, bundle

    def _files(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def path(self, day: dt.date, table: str) -> str:
        return f"{self.folder}/until={day.isoformat()}/{table}"

    def days(self) -> list[dt.date]:
        """Days whose tables are all complete; a run that broke off leaves others behind."""
        files, top = self._files(self.folder)
        if not files.exists(top):
            return []
        names = [s.getPath().getName() for s in files.listStatus(top)]
        found = [dt.date.fromisoformat(n.removeprefix("until=")) for n in names if n.startswith("until=")]
        done = [f"{t}/_SUCCESS" for t in self.bundle.tables]
        return sorted(d for d in found if all(files.exists(self._files(self.path(d, t))[1]) for t in done))

    def read(self, day: dt.date, schemas: Tables) -> Tables:
        return {
            t: self.spark.read.schema(schemas[t].schema).parquet(self.path(day, t)) for t in self.bundle.tables
        }

    def write(self, day: dt.date, tables: Tables) -> Tables:
        for name in self.bundle.tables:
            overwrite(tables[name], self.path(day, name))
        return self.read(day, tables)

    def forget(self, before: dt.date | None = None) -> None:
        """Delete the tables of all days, or of those before one."""
        files, top = self._files(self.folder)
        if before is None:
            files.delete(top, True)
            return
        for day in self.days():
            if day < before:
                files.delete(self._files(f"{self.folder}/until={day.isoformat()}")[1], True)


def extended(
    closed: ClosedStates, days: Callable[[str, dt.date | None, dt.date | None], DataFrame], until: dt.date, keep: Keep
) -> Tables:
    """The current tables of a bundle, after its closed tables were moved up to ``until``.

    ``days`` gives the rows of a table with days after one day and up to another (None: no bound).
    """
    bundle = closed.bundle

    def rows(after: dt.date | None, to: dt.date | None) -> Tables:
        return {name: days(name, after, to) for name in bundle.days}

    known = [d for d in closed.days() if d <= until]
    empty = bundle.advance(None, rows(None, until), as_it_is)
    state = closed.read(known[-1], empty) if known else None
    if not known or known[-1] < until:
        state = closed.write(until, bundle.advance(state, rows(known[-1] if known else None, until), keep))
        closed.forget(before=until)
    return bundle.advance(state, rows(until, None), keep)
