"""DuckDB twins of linear fits: normal equations by Gauss-Jordan steps.

A system is rows (sys, i, j, v) with the right-hand side in column p.  Step k
divides row k by its pivot and clears column k elsewhere; after p steps column
p holds the solution.  Grams with a ridge or of full rank need no row swaps.
"""

from __future__ import annotations

from foldwise.plans.catalog import key_sql
from foldwise.sources import fixtures as fx


def gauss_jordan(system: str, p: int) -> str:
    """Recursive CTE body: ``system`` has (sys, i, j, v), i < p, j <= p."""
    return f"""select 0 as k, sys, i, j, v from {system}
 union all
 select k + 1, sys, i, j, case when i = k then akj / akk else v - aik * akj / akk end from (
  select k, sys, i, j, v, max(case when i = k then v end) over (partition by sys, j) as akj,
   max(case when j = k then v end) over (partition by sys, i) as aik,
   max(case when i = k and j = k then v end) over (partition by sys) as akk from solved where k < {p})"""


def degree_one(prefix: str, seed: int = 0, k: int = 5) -> str:
    """Cross-validated R2 and MAE of least squares on the plain features."""
    cols = ["1.0", *fx.R1_FEATURES]
    p = len(cols)
    long = " union all ".join(f"select row_id, fold, {i} as i, cast({c} as double) as x from fo" for i, c in enumerate(cols))
    pred = " + ".join(f"{c} * max(case when w.i = {i} then w.v end)" for i, c in enumerate(cols))
    return prefix.replace("with ", "with recursive ", 1) + f""",
fo as (select *, (row_number() over (order by {key_sql(seed, 'fold')}, row_id) - 1) % {k} as fold from r1u),
z as ({long} union all select row_id, fold, {p} as i, target as x from fo),
gram as (select a.fold, a.i, b.i as j, sum(a.x * b.x) as v from z a join z b using (row_id) where a.i < {p} group by a.fold, a.i, b.i),
tot as (select i, j, sum(v) as v from gram group by i, j),
start as (select gram.fold as sys, i, j, tot.v - gram.v as v from gram join tot using (i, j)),
solved as ({gauss_jordan('start', p)}),
w as (select sys as fold, i, v from solved where k = {p} and j = {p}),
pr as (select fo.fold, fo.row_id, any_value(target) as y, {pred} as yhat from fo join w using (fold) group by fo.fold, fo.row_id, {', '.join(fx.R1_FEATURES)}),
sc as (select fold, 1 - sum((y - yhat) * (y - yhat)) / (sum(y * y) - sum(y) * sum(y) / count(*)) as r2, avg(abs(y - yhat)) as mae from pr group by fold)
select 1 as degree, io as interaction_only, {p - 1} as n_features, round(avg(r2), 6) as cv_r2_mean, round(stddev_pop(r2), 6) as cv_r2_std,
 round(avg(mae), 6) as cv_mae_mean, round(stddev_pop(mae), 6) as cv_mae_std from sc, (select unnest([true, false]) as io) group by io"""
