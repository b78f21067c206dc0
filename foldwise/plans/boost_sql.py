"""DuckDB twins of the first boosting rounds, unrolled split by split."""

from __future__ import annotations

from foldwise.functions.keys import hkey_sql, huniform_sql
from foldwise.operators.boosting import SCALE, Params
from foldwise.sources import fixtures as fx
from foldwise.sources import fixtures_sql as fq

_S = f"{SCALE:.1f}e0"


def _bins(features: list[str], p: Params) -> dict[str, str]:
    probs = ", ".join(f"{k / p.max_bins!r}e0" for k in range(1, p.max_bins))
    long = " union all ".join(f"select row_id, {i} as fi, {c} as value from src" for i, c in enumerate(features))
    names = " union all ".join(f"select {i} as fi, '{c}' as feature" for i, c in enumerate(features))
    return {
        "names": names,
        "v": long,
        "dv": "select distinct fi, value from v",
        "sizes": f"select fi, count(*) <= {p.max_bins} as few from dv group by fi",
        "rawcuts": f"""select distinct fi, cut from (
  select fi, (value + lead(value) over (partition by fi order by value)) / 2 as cut from dv join sizes using (fi) where few
  union all select fi, unnest(quantile_cont(value, [{probs}])) from v join sizes using (fi) where not few group by fi)
  where cut is not null""",
        "cuts": "select fi, cut, row_number() over (partition by fi order by cut) - 1 as bin from rawcuts",
        "vb": "select d.fi, d.value, count(k.cut) as bin from dv d left join rawcuts k on k.fi = d.fi and k.cut < d.value group by d.fi, d.value",
        "lb": "select v.row_id, v.fi, vb.bin from v join vb on v.fi = vb.fi and v.value = vb.value",
    }


def _split(name: str, at: str, p: Params) -> dict[str, str]:
    """Best split of every path of the rows in ``at`` (row_id, path, g, h)."""
    lam = f"{p.reg_lambda!r}e0"
    score = lambda g, h: f"case when {h} + {lam} > 0 then {g} * {g} / ({h} + {lam}) else 0 end"
    return {
        f"{name}_tot": f"select path, sum(g) as g, sum(h) as h, count(*) as n from {at} group by path",
        f"{name}_hist": f"select path, fi, bin, sum(g) as g, sum(h) as h, count(*) as n from {at} join lb using (row_id) group by path, fi, bin",
        f"{name}_cum": f"""select path, fi, bin, sum(g) over w as gl, sum(h) over w as hl, sum(n) over w as nl from {name}_hist
  window w as (partition by path, fi order by bin)""",
        f"{name}_side": f"""select path, fi, bin, nl, t.n - nl as nr, cast(gl as double) / {_S} as gl, cast(hl as double) / {_S} as hl,
  cast(t.g - gl as double) / {_S} as gr, cast(t.h - hl as double) / {_S} as hr, cast(t.g as double) / {_S} as g, cast(t.h as double) / {_S} as h
  from {name}_cum join {name}_tot t using (path)""",
        f"{name}_gain": f"""select path, fi, bin, nl, nr, {score('gl', 'hl')} + {score('gr', 'hr')} - ({score('g', 'h')}) as gain from {name}_side
  where nl >= {max(p.min_rows, 1)} and nr >= {max(p.min_rows, 1)} and hl >= {p.min_hessian!r}e0 and hr >= {p.min_hessian!r}e0""",
        f"{name}_best": f"""select path, fi, bin, gain from (select *, row_number() over (partition by path order by gain desc, fi, bin) as k from {name}_gain)
  where k = 1 and gain > 1e-6""",
    }


def _down(at: str, best: str) -> str:
    return f"""select a.row_id, a.g, a.h, a.path || case when lb.bin <= b.bin then 'L' else 'R' end as path
  from {at} a join {best} b using (path) join lb on lb.row_id = a.row_id and lb.fi = b.fi"""


def first_rounds(p: Params, seed: int = 0) -> str:
    """Nodes of the first two trees: two levels (growth by level), or the root and
    the better of its children (best-first, three leaves)."""
    u = huniform_sql(hkey_sql(seed, "stop", "row_id"))
    held = f"((select count(*) from t2) > 10000 and {u} < {p.validation!r}e0)" if p.validation else "false"
    ctes = {"t2": fq.T2, "src": f"select row_id, cast(target as double) as y, {held} as held, {', '.join(fx.T_NUMERIC)} from t2"}
    ctes |= _bins(fx.T_NUMERIC, p)
    ctes["m0"] = "select row_id, y, ln(cast(pos as double) / (n - pos)) as margin from src, (select count(*) as n, cast(sum(y) as bigint) as pos from src where not held) where not held"
    parts = []
    for r in range(2):
        grad = "1 / (1 + exp(-margin))"
        ctes[f"r{r}_0"] = f"""select row_id, '' as path, cast(round((pr - y) * {_S}) as bigint) as g, cast(round(pr * (1 - pr) * {_S}) as bigint) as h
  from (select *, {grad} as pr from m{r})"""
        ctes |= _split(f"r{r}a", f"r{r}_0", p)
        ctes[f"r{r}_1"] = _down(f"r{r}_0", f"r{r}a_best")
        second = _split(f"r{r}b", f"r{r}_1", p)
        if p.growth == "leaf":   # only the child with the larger gain is opened
            best = second.pop(f"r{r}b_best")
            second[f"r{r}b_all"] = best
            second[f"r{r}b_best"] = f"select * from r{r}b_all order by gain desc, path limit 1"
        ctes |= second
        ctes[f"r{r}_2"] = _down(f"r{r}_1", f"r{r}b_best")
        ctes[f"r{r}_inner"] = f"select * from r{r}a_best union all select * from r{r}b_best"
        ctes[f"r{r}_nodes"] = " union all ".join(f"select path, sum(g) as g, sum(h) as h, count(*) as n from r{r}_{k} group by path" for k in range(3))
        ctes[f"r{r}_out"] = f"""select {r} as round, length(path) as depth, path, nm.feature, c.cut as threshold, i.gain, n as rows,
  case when i.path is null then -{p.rate!r}e0 * (cast(g as double) / {_S}) / (cast(h as double) / {_S} + {p.reg_lambda!r}e0) end as value
  from r{r}_nodes left join r{r}_inner i using (path) left join names nm using (fi) left join cuts c on c.fi = i.fi and c.bin = i.bin"""
        at = f"(select row_id, path from r{r}_2 union all select row_id, path from r{r}_1 where path not in (select path from r{r}b_best))"
        ctes[f"m{r + 1}"] = f"select m.row_id, m.y, m.margin + o.value as margin from m{r} m join {at} using (row_id) join r{r}_out o using (path)"
        parts.append(f"select * from r{r}_out")
    return fq.with_(**ctes) + "select round, depth, path, feature, round(threshold, 6) as threshold, round(gain, 4) as gain, rows, round(value, 6) as value from (" + " union all ".join(parts) + ")"
