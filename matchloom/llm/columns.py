"""Names of columns: those that operators add in between, and those of tables they are given."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def free(taken: DataFrame | Iterable[str], name: str) -> str:
    """``name``, with as many underscores before it as it takes to be none of the columns'."""
    used = {c.lower() for c in (taken.columns if isinstance(taken, DataFrame) else taken)}
    while name.lower() in used:
        name = f"_{name}"
    return name


def named(name: str) -> Column:
    """The column of this name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def all_named(names: Iterable[str]) -> list[Column]:
    return [named(n) for n in names]


def others(names: Iterable[str], *gone: str) -> list[str]:
    """The names without those in ``gone``, case not counting, as Spark compares them."""
    lost = {g.lower() for g in gone}
    return [n for n in names if n.lower() not in lost]


def place(names: list[str], name: str) -> int:
    """Where a column stands, case not counting."""
    return [n.lower() for n in names].index(name.lower())


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` for columns of any name: batches have them by place."""
    numbered = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(schema.fields)])

    def by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.rename_columns(numbered.names)

    return df.toDF(*(f"c{k}" for k in range(len(df.columns)))).mapInArrow(by_place, numbered).toDF(*schema.names)
