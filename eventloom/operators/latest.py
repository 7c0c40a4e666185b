"""Top-1 per key ("latest row per group") in two physical forms.

Both pick, per ``keys``, the row with the greatest ``order_col`` (a NULL
``order_col`` counts as greatest when ``nulls_first``, the warehouse's
DESC order), ties broken by the greatest ``tiebreak`` values, so the
result is deterministic.

* ``window``: ``row_number() = 1``.  Catalyst turns this into a
  ``WindowGroupLimit``; its partial step runs before the shuffle, so a hot
  key (or the NULL key) is cut to one row per map task first.
* ``aggregate``: ``max_by(struct(row), struct(order))``, a plain
  partial/final aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_per_key(df: DataFrame, keys: list[str], order_col: str,
                   tiebreak: list | None = None, nulls_first: bool = True,
                   method: str = "window") -> DataFrame:
    tiebreak = list(tiebreak or [])
    if method == "window":
        oc = F.col(order_col)
        order = [oc.desc_nulls_first() if nulls_first else oc.desc_nulls_last()]
        order += [_c(t).desc_nulls_last() for t in tiebreak]
        w = Window.partitionBy(*keys).orderBy(*order)
        return (df.withColumn("__rn", F.row_number().over(w))
                  .where(F.col("__rn") == 1).drop("__rn"))
    if method == "aggregate":
        rest = [c for c in df.columns if c not in keys]
        ordk = ([F.col(order_col).isNull().alias("n")] if nulls_first else [])
        ordk += [F.col(order_col).alias("o")]
        ordk += [_c(t).alias(f"t{i}") for i, t in enumerate(tiebreak)]
        picked = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*ordk)).alias("__row")
        return (df.groupBy(*keys).agg(picked)
                  .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
                  .select(*df.columns))
    raise ValueError(f"unknown method {method!r}")
