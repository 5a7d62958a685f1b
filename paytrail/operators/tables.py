"""The six staged tables, with their open rows and, apart, the rows of heavy keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.config import HEAVY_ROWS
from paytrail.operators.scd import current
from paytrail.operators.slices import KEY, heavy_keys, key_struct

#: The tables of validity periods by employee.
FACTS = ("title", "salary", "department_employee")


class Tables(dict):
    """Frames by table name.

    ``parts`` are the tables over which results are made one by one and then united:
    one of the ordinary employees, whose stored facts are clustered by employee and
    need no shuffle, and, only if there are any, one of the heavy employees (``heavy``
    holds their keys and cuts), whose rows are dealt to many tasks.
    """

    def __init__(self, frames: Mapping[str, DataFrame], open_rows: Mapping[str, DataFrame] | None = None,
                 heavy: DataFrame | None = None, parts: tuple[Tables, ...] = ()):
        super().__init__(frames)
        self.heavy = heavy
        self._open = dict(open_rows or {})
        self.parts = parts or (self,)

    def open_rows(self, name: str) -> DataFrame:
        """Rows still valid; from the stored partition of open rows where there is one."""
        return self._open[name] if name in self._open else current(self[name])

    @classmethod
    def of(cls, t: Mapping[str, DataFrame], rows: int | None = HEAVY_ROWS) -> Tables:
        """``t`` itself if it comes from a warehouse, else its heavy keys are counted here."""
        if isinstance(t, Tables) and rows == HEAVY_ROWS:
            return t
        heavy = heavy_employees(t, rows)
        if heavy is None:
            return cls(t)
        split = {n: split_heavy(t[n], heavy) for n in FACTS}
        return cls.united(t, [cls({**t, **{n: s[0] for n, s in split.items()}}),
                              cls({**t, **{n: s[1] for n, s in split.items()}}, heavy=heavy)])

    @classmethod
    def united(cls, frames: Mapping[str, DataFrame], parts: list[Tables]) -> Tables:
        return cls(frames, parts=tuple(parts))


def heavy_employees(t: Mapping[str, DataFrame], rows: int | None = HEAVY_ROWS) -> DataFrame | None:
    """Employees with more than ``rows`` title, salary and department periods."""
    return heavy_keys([(t[name], ["employee_id"], "from_date") for name in FACTS], rows)


def split_heavy(df: DataFrame, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary and rows of heavy employees."""
    keys, keyed = heavy.select(KEY), df.withColumn(KEY, key_struct(["employee_id"]))
    return keyed.join(keys, KEY, "left_anti").select(df.columns), keyed.join(keys, KEY, "left_semi").select(df.columns)


def unite(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
