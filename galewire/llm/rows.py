"""Row identity and ranks that stay spread over many tasks."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galewire.sources.scratch import materialize

SLICE_ROWS = 1 << 12  # rows a single sort of a ranked group holds, about


def _digest(docs: DataFrame) -> Column:
    """Two hashes of a row's content: equal for rows that are equal in all columns."""
    # Maps have no hash of their own; a null must not let its neighbours move up.
    cols = [
        F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes
    ]
    nulls = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return F.struct(*[F.xxhash64(F.lit(seed), nulls, *cols).alias(f"h{seed}") for seed in (1, 2)])


def with_row_id(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns), ``digest`` of its content, and ``rid``, unique per row,
    whatever the rows hold.

    A frame read straight from files names each row by file and position. Any other frame is
    written once, for an id must not change when a lost task runs again. Both change with the place
    of a row: join by ``rid``, order by ``digest``, with ``rid`` for equal rows only.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    digest = _digest(docs).alias("digest")
    if "_metadata" not in docs.columns:
        try:
            return docs.select(row, digest, F.struct("_metadata.file_path", "_metadata.row_index").alias("rid"))
        except Exception as error:  # noqa: BLE001
            if "UNRESOLVED_COLUMN" not in str(error) and "FIELD_NOT_FOUND" not in str(error):
                raise
    return materialize(docs.select(row, digest).withColumn("rid", F.monotonically_increasing_id()), "rows")


def order_key(seed: int, *cols: Column) -> Column:
    """A seeded pseudo-random order: 63 bits, not negative."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 1)


def key_shift(rows: int, bits: int = 63) -> int:
    """How far to shift an ``order_key`` so that slices of one group hold about SLICE_ROWS."""
    return bits - max(0, math.ceil(math.log2(max(rows, 1) / SLICE_ROWS)))


def ranked(
    df: DataFrame, group: list[str], key: str, shift: int, ties: list[str], weight: str | None = None
) -> DataFrame:
    """``df`` with ``rank`` (from 0 within the group, by key and ties), ``group_rows`` and, with a
    weight, ``start`` (the weights before it) and ``group_weight``.

    A group is cut into slices of its key, ranked apart, and moved by what the slices before hold:
    no task sorts a whole group. ``df`` is read twice and must give the same rows each time; the
    group columns must not be null.
    """
    w = F.col(weight) if weight else F.lit(0).cast("long")
    sliced = df.withColumn("_slice", F.shiftright(F.col(key), shift))
    per = sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_n"), F.sum(w).alias("_w"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(
        *group, "_slice",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_w0"),
        F.sum("_n").over(whole).alias("group_rows"),
        F.sum("_w").over(whole).alias("group_weight"),
    )
    own = Window.partitionBy(*group, "_slice").orderBy(key, *ties)
    out = sliced.join(offsets, [*group, "_slice"]).withColumn(
        "rank", F.col("_n0") + F.row_number().over(own) - 1
    )
    if weight:
        upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn("start", F.col("_w0") + F.sum(w).over(upto) - w)
        return out.drop("_slice", "_n0", "_w0")
    return out.drop("_slice", "_n0", "_w0", "group_weight")
