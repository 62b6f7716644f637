"""State of many keys as tables: a group's rows in buckets, each stored as one value.

A call per key costs more than a key's few numbers. A micro-batch reads and writes the buckets that
its rows touch, whole, so their number bounds what a single row can cost.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

# Stands for NULL, as pandas would make whole numbers with NULL floats.
NONE = -(1 << 63)

BUCKETS = 16


def part_and_bucket(*keys: str, parts: int, buckets: int = BUCKETS) -> tuple[Column, Column]:
    """The part (group) and, within it, the bucket of a key."""
    place = F.pmod(F.xxhash64(*keys), F.lit(parts * buckets))
    return F.pmod(place, F.lit(parts)).alias("part"), F.floor(place / parts).cast("int").alias("bucket")


def or_none(value: Column) -> Column:
    """A whole number, NONE for NULL."""
    return F.coalesce(value, F.lit(NONE))


def nullable(values: pd.Series) -> pd.Series:
    """Whole numbers with NULL for NONE."""
    return values.astype("Int64").mask(values == NONE)


def same(a: pd.Series, b: pd.Series) -> np.ndarray:
    """Equality of texts in which NULL equals NULL."""
    return (a.isna().to_numpy() & b.isna().to_numpy()) | (a.to_numpy() == b.to_numpy())


class Table:
    """Rows of a group, with a column ``bucket``."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, schema: pa.Schema) -> None:
        self.schema = schema
        self.state = handle.getMapState(name, "bucket int", "data binary")

    def read(self, buckets: Iterable[int] | None = None) -> pd.DataFrame:
        """The rows of the buckets, of all by default."""
        if buckets is None:
            stored = [v for _, v in self.state.iterator()]
        else:
            stored = [v for v in (self.state.getValue((int(b),)) for b in buckets) if v is not None]
        tables = [pa.ipc.open_stream(bytes(v[0])).read_all() for v in stored]
        return (pa.concat_tables(tables) if tables else self.schema.empty_table()).to_pandas()

    def write(self, rows: pd.DataFrame, buckets: Iterable[int]) -> None:
        """Replace the buckets by those rows, which are all theirs."""
        rows = rows.sort_values("bucket", kind="stable")
        table = pa.Table.from_pandas(rows[self.schema.names], self.schema, preserve_index=False)
        numbers = rows["bucket"].to_numpy()
        for bucket in buckets:
            first, end = np.searchsorted(numbers, bucket), np.searchsorted(numbers, bucket, "right")
            if first < end:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, self.schema) as out:
                    out.write_table(table.slice(first, end - first))
                self.state.updateValue((int(bucket),), (sink.getvalue().to_pybytes(),))
            elif self.state.containsKey((int(bucket),)):
                self.state.removeKey((int(bucket),))


class Clock:
    """One timer of a group at a time, so that a group is swept once in ``keep_ms`` at most."""

    def __init__(self, handle: StatefulProcessorHandle, keep_ms: int) -> None:
        self.handle, self.keep_ms = handle, keep_ms
        self.due = handle.getValueState("due", "at bigint")

    def wind(self, now: int) -> None:
        if not self.due.exists():
            at = now + self.keep_ms + 1
            self.due.update((at,))
            self.handle.registerTimer(at)

    def rang(self, now: int, again: bool) -> None:
        self.due.clear()
        if again:
            self.wind(now)
