"""Skew-safe equi-join for pair finding.

Self-joins on a group key (same exam/question/answer hash, same text chunk)
are quadratic in the group size, and one group may hold a third of all rows.
A plain shuffle join sends each key to one task; AQE's skew handling can
split one side of a skewed partition but not a single key on both sides of a
self-join.  ``grid_join`` therefore splits every *hot* key (more than
``cell_rows`` rows on a side) into a ``bl x br`` grid of cells: each left row
of the key goes to one grid row and is copied to every grid column, each right
row goes to one grid column and is copied to every grid row.  Every left/right
combination meets in exactly one cell, and no cell holds more than about
``cell_rows`` rows per side, so no task ever receives a whole hot group.

Keys at or below ``cell_rows`` on both sides get a 1 x 1 grid (no copies).
The hot-key table has at most ``rows / cell_rows`` entries by construction;
it is written once and counted: no hot keys means no extra join at all, a
count under ``max_broadcast_keys`` means a broadcast, and only beyond that a
shuffle join (whose skewed partitions AQE splits).
Cell assignment hashes a stable row attribute (never ``rand()``), so a
recomputed task after an executor loss lands every row in the same cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probity.session import materialize

DEFAULT_CELL_ROWS = 4096


def hot_keys(left: DataFrame, right: DataFrame | None, keys: list[str],
             cell_rows: int = DEFAULT_CELL_ROWS) -> DataFrame:
    """Grid shape for keys with more than ``cell_rows`` rows on either side
    (``right=None``: a self-join, one count serves both sides)."""
    lk = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl"))
    if right is None:
        both = lk.withColumn("_nr", F.col("_nl"))
    else:
        rk = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr"))
        both = lk.join(rk, keys)
    return _grid_of(both, keys, cell_rows)


def _grid_of(sizes: DataFrame, keys: list[str], cell_rows: int) -> DataFrame:
    return (sizes
            .filter((F.col("_nl") > cell_rows) | (F.col("_nr") > cell_rows))
            .select(*keys,
                    F.ceil(F.col("_nl") / cell_rows).cast("int").alias("_bl"),
                    F.ceil(F.col("_nr") / cell_rows).cast("int").alias("_br")))


def grid_join(left: DataFrame, right: DataFrame, keys: list[str],
              left_salt: Column, right_salt: Column,
              condition: Column | None = None,
              cell_rows: int = DEFAULT_CELL_ROWS, self_join: bool = False,
              partitions: int | None = None,
              max_broadcast_keys: int = 100_000, sizes: DataFrame | None = None) -> DataFrame:
    """Inner equi-join of ``left`` and ``right`` on ``keys`` (+ ``condition``).

    ``left`` and ``right`` must not share non-key column names.
    ``left_salt``/``right_salt`` are stable per-row values (an id) used to
    spread a hot key's rows over grid cells.  ``self_join=True`` says both
    sides are projections of the same rows (key sizes are counted once).
    ``sizes`` (keys, ``_nl``, ``_nr``) gives the rows of each key on either side where the
    caller has counted them already.

    Both sides are hash-partitioned on (keys, cell) into ``partitions``
    (default: the session's shuffle partitions).  The join's output is far
    larger than its input, so sizing its tasks by input bytes -- what AQE's
    partition coalescing does -- would funnel all pairs into a few tasks; an
    explicit partition count is left as is.
    """
    found = _grid_of(sizes, keys, cell_rows) if sizes is not None else hot_keys(left, None if self_join else right, keys, cell_rows)
    hot = materialize(found, "hot-keys")
    n_hot = hot.count()          # a small job over the written hot-key table
    n = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = F.lit(1)
    if n_hot == 0:               # the common case: no key needs splitting
        lg = left.select(*left.columns, F.lit(0).alias("_gi"), F.lit(0).alias("_gj"))
        rg = right.select(*right.columns, F.lit(0).alias("_gi"), F.lit(0).alias("_gj"))
    else:
        # attach grid shapes without routing a hot key's rows to one task:
        # broadcast the (counted) hot-key table when it is small enough,
        # otherwise a shuffle join whose skewed partitions AQE splits
        h = F.broadcast(hot) if n_hot <= max_broadcast_keys else hot
        lg = (left.withColumn("_ls", F.xxhash64(left_salt))
              .join(h, keys, "left")
              .select(*left.columns,
                      F.pmod(F.col("_ls"), F.coalesce(F.col("_bl"), one)).cast("int").alias("_gi"),
                      F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_br"), one) - 1)).alias("_gj")))
        rg = (right.withColumn("_rs", F.xxhash64(right_salt))
              .join(h, keys, "left")
              .select(*right.columns,
                      F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_bl"), one) - 1)).alias("_gi"),
                      F.pmod(F.col("_rs"), F.coalesce(F.col("_br"), one)).cast("int").alias("_gj")))
    part = [*keys, "_gi", "_gj"]
    lg, rg = lg.repartition(n, *part).alias("_L"), rg.repartition(n, *part).alias("_R")

    def L(c):
        return F.col(f"_L.`{c}`")

    def R(c):
        return F.col(f"_R.`{c}`")

    cond = L("_gi") == R("_gi")
    for c in [*keys, "_gj"]:
        cond = cond & (L(c) == R(c))
    if condition is not None:
        cond = cond & condition
    joined = lg.join(rg, cond, "inner")
    return joined.select(*[L(k).alias(k) for k in keys],
                         *[L(c) for c in left.columns if c not in keys],
                         *[R(c) for c in right.columns if c not in keys])
