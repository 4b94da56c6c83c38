"""Step-by-step calculations along the weeks of one key.

A step may need the rounded result of the step before, which no window gives. The
weeks of a key (at most the calendar's) are gathered, sorted and folded with the
built-in ``aggregate``, so the work stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_rows(
    df: DataFrame,
    keys: list[str],
    order: str,
    fields: list[str],
    state: dict[str, str],
    step: Callable[[Column, Column], dict[str, Column]],
    outputs: dict[str, str],
) -> DataFrame:
    """Fold every key's rows in order.

    ``state`` maps carried names to types, all starting as NULL. ``step(acc, row)``
    returns the next value of every state name and of every output name.
    Returns keys, order, fields and outputs.
    """
    rows = df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(order, *fields))).alias("_rows")
    )
    out_type = ",".join(f"{n}:{t}" for n, t in outputs.items())
    start = F.struct(
        *[F.lit(None).cast(t).alias(n) for n, t in state.items()],
        F.expr(f"cast(array() as array<struct<{out_type}>>)").alias("_out"),
    )

    def merge(acc: Column, row: Column) -> Column:
        new = step(acc, row)
        emitted = F.struct(*[new[n].cast(t).alias(n) for n, t in outputs.items()])
        return F.struct(
            *[new[n].cast(t).alias(n) for n, t in state.items()],
            F.array_append(acc["_out"], emitted).alias("_out"),
        )

    zipped = F.arrays_zip("_rows", F.aggregate("_rows", start, merge)["_out"].alias("_out"))
    flat = rows.select(*keys, F.explode(zipped).alias("_z"))
    return flat.select(
        *keys,
        F.col("_z._rows")[order].alias(order),
        *[F.col("_z._rows")[f].alias(f) for f in fields],
        *[F.col("_z._out")[n].alias(n) for n in outputs],
    )
