"""Shared helpers: reading inputs, written intermediate tables, per-batch Python steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.session import shared_dir

# The characters that separate words in all contracts: space and \x09 to \x0D.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the folder all executors share.

    It cuts the lineage: a lost executor costs its running tasks only. The shuffle files
    behind it are of no further use and go as soon as the table stands.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A name for a helper column that the rows do not have, in whatever case."""
    taken = {name.lower() for name in df.columns}
    number = 0
    while f"__{base}{number}" in taken:
        number += 1
    return f"__{base}{number}"


def join_copies(rows: DataFrame, more: DataFrame, key: str, deals: int = 16) -> DataFrame:
    """``rows`` with what ``more`` has for their ``key`` (one row a key), NULL for the others.

    Many rows may share a key, as copies of one text do. They are dealt by ``doc_id`` over
    ``deals`` keys of the join, and each row of ``more`` goes to all of these, so no task gets
    all copies. The deal follows the row alone, so a repeated task deals alike.
    """
    deal = free_name(rows, "deal")
    dealt = rows.withColumn(deal, F.pmod(F.xxhash64("doc_id"), F.lit(deals)).cast("int"))
    spread = more.withColumn(deal, F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    return dealt.join(spread, [key, deal], "left").drop(deal)


def row_key(*columns: str) -> Column:
    """A 64-bit key of the columns' contents; NULL and empty differ."""
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def arrow_schema(columns: str) -> pa.Schema:
    """The Arrow form of a schema given as text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(columns))


def slices(batch: pa.RecordBatch, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``slice_bytes`` together."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.full(batch.num_rows, 100)  # what a row costs besides its texts
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes) - sizes) // slice_bytes
    starts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, end in zip(starts, starts[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def in_batches(
    df: DataFrame,
    make: Callable[[], Callable[[dict[str, list]], dict[str, object]]],
    schema: str,
    slice_bytes: int = 2_000_000,
) -> DataFrame:
    """Rows of ``df`` through a Python step, about ``slice_bytes`` of text at a time.

    ``make`` runs once a task and returns the step; the step gets a list for
    each column and returns the new columns, which follow the old ones named
    in ``schema`` by name. What a task holds follows the slice, or its longest row.
    """
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in slices(batch, slice_bytes):
                columns = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                made = step({n: c.to_pylist() for n, c in columns.items()})
                arrays = []
                for field in target:
                    got = made[field.name] if field.name in made else columns[field.name]
                    if not isinstance(got, pa.Array):
                        got = pa.array(got, type=field.type)
                    arrays.append(got if got.type == field.type else got.cast(field.type))
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)
