"""Counts that a write brings along, so that no table is scanned to be counted."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class CountedRows:
    """``frame`` is ``df``; once it has been written, :meth:`counts` knows how many rows passed.

    Rows are counted for each of ``values`` in the column ``by`` and for each named
    test, in the tasks that write them. Write ``frame`` itself, once, with nothing
    after it: tasks of a write's last stage are counted when they succeed and then
    once only, so lost executors, repeated and speculative attempts add nothing,
    while a shuffle behind the counting could run it again. What is read from the
    written table afterwards is counted by nobody.
    """

    def __init__(self, df: DataFrame, values: list[str], tests: dict[str, Column], by: str = "source_name") -> None:
        self._values, self._tests = list(values), list(tests)
        self._observation = Observation(f"counted-{uuid.uuid4().hex}")
        columns = [
            F.count_if(F.col(by).eqNullSafe(F.lit(value)) & test).alias(f"{number}:{name}")
            for number, value in enumerate(self._values)
            for name, test in tests.items()
        ]
        self.frame = df.observe(self._observation, *columns) if columns else df

    def counts(self) -> dict[str, dict[str, int]]:
        """Rows by value and test. Waits for the write."""
        found = self._observation.get if self._values and self._tests else {}
        # A frame that the optimizer finds to be empty brings no counts.
        return {
            value: {name: found.get(f"{number}:{name}", 0) for name in self._tests}
            for number, value in enumerate(self._values)
        }
