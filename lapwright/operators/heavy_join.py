"""Equality join that spreads frequent keys over many tasks by a sketch of the keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY, _SLOTS, _SLOT = "__key", "__slots", "__slot"
GRAIN = 16  # slots that a task's even share of all rows is cut into


def heavy_keys(rows: DataFrame, on: Sequence[str], tasks: int) -> DataFrame:
    """Hashes of keys with at least half of a task's even share of rows, and the slots to deal them over.

    A frequent-items sketch with room for 64 keys a task (a million in all), merged from those of all map tasks: its
    counts are wrong by a small part of such a share, and it names two keys a task at most.
    """
    sketch = f"approx_top_k({_KEY}, {2 * tasks}, {min(1_000_000, max(1024, 64 * tasks))})"
    found = rows.select(F.xxhash64(*on).alias(_KEY)).agg(F.count(F.lit(1)).alias("n"), F.expr(sketch).alias("top"))
    each = found.select("n", F.explode("top").alias("top")).where(F.col("top.count") * 2 * tasks >= F.col("n"))
    slots = F.ceil(F.col("top.count") * (GRAIN * tasks) / F.col("n")).cast("int")
    return each.select(F.col("top.item").alias(_KEY), slots.alias(_SLOTS))


def join_heavy(rows: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner", tasks: int | None = None) -> DataFrame:
    """Join the large ``rows`` with ``other`` on equal columns, frequent keys of ``rows`` in slots.

    A row of a frequent key goes to one slot by its hash; rows of ``other`` with that key are repeated
    for all its slots, which adds at most ``GRAIN`` + 2 copies a task where ``other`` has one row per key. Other
    keys have one slot. Only the list of frequent keys, two per task at most, is broadcast. Unlike the splitting of
    large partitions at run time this depends on no size threshold, and it holds for semi and anti joins.

    The result is that of the plain join: NULL keys match nothing, repeated rows stay, and empty sides are allowed.
    Rows equal in all columns share a slot. Joins that keep unmatched rows of ``other`` are refused.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} joins cannot repeat the other side")
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(rows, on, tasks))
    key = F.xxhash64(*on)
    slots = F.coalesce(F.col(_SLOTS), F.lit(1))
    mixed = F.xxhash64(F.lit(1), *(c for c in _hashable(rows)))
    placed = rows.withColumn(_KEY, key).join(heavy, _KEY, "left").withColumn(_SLOT, F.pmod(mixed, slots).cast("int"))
    repeated = other.withColumn(_KEY, key).join(heavy, _KEY, "left").withColumn(
        _SLOT, F.explode(F.sequence(F.lit(0), slots - 1))
    )
    helpers = (_KEY, _SLOTS)
    return placed.drop(*helpers).join(repeated.drop(*helpers), [*on, _SLOT], how).drop(_SLOT)


def _hashable(rows: DataFrame) -> list[str]:
    """Columns that can be hashed; maps and variants cannot."""
    return [f"`{c}`" for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]


def join_rows(rows: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner", spread: bool | None = None) -> DataFrame:
    """Join of rows that may have frequent keys: by slots, or left to adaptive execution where that splits skewed joins.

    ``spread`` settles it; left out, the session's settings do. Adaptive splitting needs no second look at the keys.
    """
    if spread is None:
        conf = rows.sparkSession.conf
        spread = not all(
            conf.get(f"spark.sql.adaptive.{name}") == "true" for name in ("enabled", "skewJoin.enabled")
        )
    return join_heavy(rows, other, on, how) if spread else rows.join(other, list(on), how)
