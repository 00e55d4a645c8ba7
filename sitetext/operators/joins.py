"""A left join that survives hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.functions import broadcast, expr

# A key with more rows than this is split over several tasks.
HOT_ROWS = 100_000
# At most this many keys are treated as hot, which bounds what is broadcast.
MAX_HOT_KEYS = 10_000


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    left_rows: int,
    hot_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a side with one row per key, when many left rows may share a key.

    Left rows are narrow here and compress well when they share a key, so adaptive execution
    does not see how many there are. Keys with many rows are counted instead: their left rows
    are spread by the hash of `spread_by`, and their right row is copied once per part.
    `left_rows` is the number of left rows; it sets the count from which a key is hot so that
    there are no more than MAX_HOT_KEYS of them. `counted` is a cheaper frame to count them in,
    with the same keys row by row.
    """
    hot_from = max(hot_rows or HOT_ROWS, left_rows // MAX_HOT_KEYS)
    hot = (
        (left if counted is None else counted)
        .groupBy(*keys)
        .count()
        .where(f"count > {hot_from}")
        .select(*keys, expr(f"CAST(ceil(count / {hot_from}) AS int) AS _parts"))
    )
    spread = left.join(broadcast(hot), list(keys), "left").withColumn(
        "_part", expr(f"CAST(pmod(xxhash64({spread_by}), coalesce(_parts, 1)) AS int)")
    )
    copies = right.join(broadcast(hot), list(keys), "left").withColumn(
        "_part", expr("explode(sequence(0, coalesce(_parts, 1) - 1))")
    )
    joined = spread.drop("_parts").join(copies.drop("_parts"), [*keys, "_part"], "left")
    return joined.drop("_part")
