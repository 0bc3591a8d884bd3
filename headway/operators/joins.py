"""Join helpers shared by the models.

Which side of a join is broadcast is left to Spark (by the bytes it
estimates, and by AQE at run time), as is the splitting of skewed shuffle
partitions.  What Spark can't see is how many rows a join or an expansion
will *emit* for a key, so that is handled here:

* ``grid_join``: a join whose hot keys are cut into a grid of cells.  A key
  with ``left_cells`` x ``right_cells`` cells deals its left rows over
  ``left_cells`` rows of the grid and its right rows over ``right_cells``
  columns; each side is copied along the other's axis, so every pair meets
  in exactly one cell.  The joins are plain shuffles on (key, cell), so the
  cells of any number of hot keys spread over all partitions and AQE can
  still split them.
* ``cells``: the grid of each key from its rows on either side, such that a
  cell emits about ``rows_per_task`` pairs.
* ``spread``: deals rows evenly before they are exploded, into partitions
  sized from the number of rows that will be emitted.

No row is dropped, and no number of keys or cells is capped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one task should emit.
ROWS_PER_TASK = 2_000_000
#: Tasks of one expansion; 5e11 rows are then 15 million a task.
MOST_TASKS = 32_768
_LEFT, _RIGHT = "__left_cell", "__right_cell"


def partitions_for(spark, rows: int | None, rows_per_task: int | None = None) -> int:
    """Partitions for a step that emits ``rows`` rows: the session's shuffle
    partitions, or more when tasks would emit over ``rows_per_task`` rows, up
    to ``MOST_TASKS``.  Emitted rows stream out of a task, so a longer task
    needs no more memory, while the cost of a shuffle grows with its tasks."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-int(rows or 0) // (rows_per_task or ROWS_PER_TASK))
    return max(base, min(wanted, MOST_TASKS))


def spread(df: DataFrame, rows: int | None, *columns: str) -> DataFrame:
    """``df`` dealt by ``columns`` for an expansion to ``rows`` rows.  The
    explicit count keeps AQE from merging a small input into few tasks that
    would then emit everything."""
    return df.repartition(partitions_for(df.sparkSession, rows), *columns)


def cells(loads: DataFrame, left_rows: str, right_rows: str,
          rows_per_task: int | None = None) -> DataFrame:
    """``loads`` (one row per key) restricted to hot keys, those whose pairs
    exceed ``rows_per_task``, with ``left_cells`` and ``right_cells``.

    A cell has at most ``side`` rows of either side, where side * side is
    ``rows_per_task``; a side that is smaller than that isn't cut, and the
    other one is cut all the finer."""
    limit = rows_per_task or ROWS_PER_TASK
    side = max(1, int(limit ** 0.5))
    hot = loads.where(F.col(left_rows) * F.col(right_rows) > limit)
    left = F.least(F.col(left_rows), F.greatest(F.lit(side), F.expr(
        f"{limit} DIV greatest({right_rows}, 1)")))
    right = F.least(F.col(right_rows), F.greatest(F.lit(side), F.expr(
        f"{limit} DIV greatest({left_rows}, 1)")))
    return hot.select("*", F.ceil(F.col(left_rows) / left).cast("long").alias("left_cells"),
                      F.ceil(F.col(right_rows) / right).cast("long").alias("right_cells"))


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], grid: DataFrame | None,
              left_columns: Sequence[str] = (), right_columns: Sequence[str] = ()) -> DataFrame:
    """``left.join(right, keys)`` with the keys of ``grid`` (keys, left_cells,
    right_cells; None: no hot key) cut into cells.

    Rows are dealt to cells by a hash of ``left_columns`` / ``right_columns``
    (default: all), so a recomputed task deals them the same way."""
    keys = list(keys)
    if grid is None:
        return left.join(right, keys)
    grid = grid.select(*keys, "left_cells", "right_cells")

    def dealt(df: DataFrame, own: str, other: str, mine: str, theirs: str,
              columns: Sequence[str]) -> DataFrame:
        salt = F.xxhash64(*[F.col(c) for c in (list(columns) or df.columns)])
        cut = df.join(grid, keys, "left")
        return cut.withColumn(own, F.pmod(salt, F.coalesce(F.col(mine), F.lit(1)))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"),
                                        F.coalesce(F.col(theirs), F.lit(1)) - 1))).drop(
            "left_cells", "right_cells")

    a = dealt(left, _LEFT, _RIGHT, "left_cells", "right_cells", left_columns)
    b = dealt(right, _RIGHT, _LEFT, "right_cells", "left_cells", right_columns)
    return a.join(b, [*keys, _LEFT, _RIGHT]).drop(_LEFT, _RIGHT)
