"""Aggregation through a dimension lookup, with the plan chosen by size.

``GROUP BY dim.attr`` over ``fact JOIN dim`` has two good plans:

* the dimension is within the planner's broadcast size in bytes: join
  map-side and aggregate once — one stage, the shuffle carries only
  partial aggregates;
* the dimension is large: aggregate the fact on the foreign key first
  (map-side combined, so a hot key collapses to one row per task), then
  join the much smaller result to the dimension and aggregate again.

Catalyst does not push aggregates below joins by itself, so the choice is
made here. Partial aggregates must be re-aggregatable by ``sum``
(sums and counts); final expressions are written over partial names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.operators.joins import plan_broadcasts


def grouped_through(fact: DataFrame, fk: str, dim: DataFrame, dim_cols: list[str],
                    fact_keys: list[str], partials: dict[str, Column],
                    finals: dict[str, Column] | None = None,
                    dim_is_small: bool | None = None) -> DataFrame:
    """Group ``fact ⋈ dim`` (on ``fk``) by ``dim_cols + fact_keys``.

    ``dim`` must have unique ``fk`` values and contain ``fk`` and ``dim_cols``.
    Returns the group columns, then ``finals`` (or the partials if none).
    """
    if dim_is_small is None:
        dim_is_small = plan_broadcasts(dim)
    keys = list(dim_cols) + list(fact_keys)
    d = dim.select(fk, *[c for c in dim_cols if c != fk])
    if dim_is_small:
        out = fact.join(d, fk).groupBy(*keys).agg(
            *[c.alias(n) for n, c in partials.items()])
    else:
        pre = fact.groupBy(fk, *fact_keys).agg(*[c.alias(n) for n, c in partials.items()])
        out = pre.join(d, fk).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in partials])
    if finals:
        out = out.select(*keys, *[c.alias(n) for n, c in finals.items()])
    return out


def aggregate_by_attributes(star, fact: DataFrame, attrs: list[str], partials: dict[str, Column]) -> DataFrame:
    """Group ``fact`` by ``attrs`` — fact columns or attributes of the star's
    dimensions — computing ``partials`` (each re-aggregatable by ``sum``).

    When the planner broadcasts every dimension involved, the fact is
    aggregated once. Otherwise the fact is first
    aggregated on its own group columns plus the foreign keys (map-side
    combined), and only that result meets the dimensions. ``star`` may be
    None when all ``attrs`` are fact columns.
    """
    from shiftline.operators.star import ATTR_SOURCE
    own = [a for a in attrs if a in fact.columns]
    needed: dict[tuple[str, str], list[str]] = {}
    for a in attrs:
        if a not in own:
            d, k = ATTR_SOURCE[a]
            needed.setdefault((d, k), []).append(a)
    aggs = [c.alias(n) for n, c in partials.items()]
    if not needed or all(star.is_small(d) for d, _ in needed):
        f = fact
        for (d, k), cols in needed.items():
            f = f.join(star.dim(d, k, *cols), k)
        return f.groupBy(*attrs).agg(*aggs)
    pre = fact.groupBy(*dict.fromkeys(own + [k for _, k in needed])).agg(*aggs)
    for (d, k), cols in needed.items():
        pre = pre.join(star.dim(d, k, *cols), k)
    return pre.groupBy(*attrs).agg(*[F.sum(n).alias(n) for n in partials])
