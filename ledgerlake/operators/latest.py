"""Keep the latest row per key (``row_number() ... = 1`` without a window).

``row_number`` over ``partitionBy(key)`` sends every row of a key to one
task; one key holding a third of the data then becomes one task holding a
third of the data. The same result is an aggregate: the row whose
``struct(order..., tie-break...)`` is largest. ``max`` is combined map-side
(partial aggregation), so a hot key is reduced to one row per map task
before the shuffle.

Spark 3.5+ also gives ``row_number() ... = 1`` a partial ``WindowGroupLimit``
before the shuffle, so the window form is skew-safe too while that rule
applies (it is off above ``spark.sql.optimizer.windowGroupLimitThreshold``);
measured on D18 at sf0.1 the two are within 0.1 s. The aggregate does not
depend on an optimizer rule. Both are sort-based (the struct buffer is not
fixed-width), and both send at most one row per key per map task.

Order semantics: ordering columns descending with NULLs last (NULL struct
fields compare lowest), ties broken by the remaining columns descending, so
the choice is total and reproducible, unlike the reference's bare
``row_number`` whose pick among equal timestamps is arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PICK = "__latest"


def keep_latest(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the greatest by ``order_desc`` then ``tie_break``.

    ``tie_break`` defaults to every other column in frame order. The output
    keeps the input column order. NULL keys form one group, as in a window.
    """
    keys = list(keys)
    order_desc = list(order_desc)
    others = [c for c in df.columns if c not in keys and c not in order_desc]
    tb = list(tie_break) if tie_break is not None else others
    payload = order_desc + [c for c in tb if c not in order_desc]
    payload += [c for c in others if c not in payload]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*payload)).alias(_PICK))
    return picked.select(*[F.col(c) if c in keys else F.col(f"{_PICK}.{c}").alias(c)
                           for c in df.columns])
