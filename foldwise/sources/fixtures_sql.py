"""DuckDB twins of the fixture builders, used by the oracle queries.

Each constant is a SELECT that produces the same rows and columns as the
Spark builder of the same name in ``fixtures``.
"""

from __future__ import annotations

from foldwise.functions.keys import hkey_sql, huniform_sql
from foldwise.sources import fixtures as fx

NET = "(l_extendedprice * (1 - l_discount) * (1 + l_tax))"

LINEITEM_ROW_ID = (
    "md5(concat_ws('|', cast(l_orderkey as varchar), cast(l_partkey as varchar), "
    "cast(l_suppkey as varchar), cast(l_linenumber as varchar), "
    "cast(cast(l_quantity as bigint) as varchar), "
    "cast(cast(round(l_extendedprice*100) as bigint) as varchar), "
    "cast(cast(round(l_discount*100) as bigint) as varchar), "
    "cast(cast(round(l_tax*100) as bigint) as varchar), l_returnflag, l_linestatus, "
    "cast(cast(l_shipdate as date) as varchar)))")


def _cast_list(cols):
    return ", ".join(f"cast({c} as double) as {c}" for c in cols)


N1 = f"""
select o_orderkey as row_id, cast(a.avg_net > {fx.N1_NET_THRESHOLD} as integer) as target,
       {_cast_list(fx.N1_FEATURES)}
from (select o_orderkey, o_totalprice, cast(month(o_orderdate) as double) as o_month from orders) o
join (select l_orderkey, cast(count(*) as double) as n_lines, sum(l_quantity) as sum_qty,
             avg(l_discount) as avg_disc, avg(l_tax) as avg_tax, avg(l_extendedprice) as avg_price,
             max(l_extendedprice) as max_price, avg({NET}) as avg_net
      from lineitem group by l_orderkey) a on o.o_orderkey = a.l_orderkey
"""

_spend_cols = ",\n  ".join(
    f"sum(case when o_orderpriority = '{p}' then o_totalprice else 0.0 end) as {c}"
    for p, c in zip(fx.PRIORITIES, fx.PRIORITY_COLS))
_total = " + ".join(fx.PRIORITY_COLS)
N2 = f"""
select row_id,
       cast((case when ({_total}) > 0 then (spend_urgent + spend_high) / ({_total}) else 0.0 end)
            > {fx.N2_SHARE_THRESHOLD} as integer) as target,
       {", ".join(fx.N2_FEATURES)}
from (select c.c_custkey as row_id, {", ".join(f"coalesce(s.{c}, 0.0) as {c}" for c in fx.PRIORITY_COLS)},
             cast(c.c_acctbal as double) as c_acctbal
      from customer c left join (select o_custkey, {_spend_cols} from orders group by o_custkey) s
      on c.c_custkey = s.o_custkey) t
"""

R1 = f"""
select {LINEITEM_ROW_ID} as row_id, {NET} / 10000.0 as target,
       cast(l_quantity as double) as l_quantity, cast(l_extendedprice as double) as l_extendedprice,
       cast(l_discount as double) as l_discount, cast(l_tax as double) as l_tax,
       cast(p_size as double) as p_size, cast(p_retailprice as double) as p_retailprice,
       cast(month(l_shipdate) as double) as ship_month, cast(s_acctbal as double) as s_acctbal
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
"""

_T_BASE = ("from lineitem join (select o_orderkey, o_orderpriority from orders) o on l_orderkey = o.o_orderkey "
           "join part on l_partkey = p_partkey")
_T_NUM = ("cast(l_quantity as double) as l_quantity, cast(l_extendedprice as double) as l_extendedprice, "
          "cast(l_discount as double) as l_discount, cast(l_tax as double) as l_tax, "
          "cast(p_size as double) as p_size, cast(p_retailprice as double) as p_retailprice, "
          "cast(month(l_shipdate) as double) as ship_month")


def t1(threshold: float = fx.T1_NET_THRESHOLD) -> str:
    return (f"select {LINEITEM_ROW_ID} as row_id, cast({NET} > {threshold} as integer) as target, "
            f"{_T_NUM}, l_returnflag, l_linestatus, o_orderpriority, p_type {_T_BASE}")


T1 = t1()
T2 = t1(fx.T2_NET_THRESHOLD)
T3_RAW = (f"select {LINEITEM_ROW_ID} as row_id, cast(l_extendedprice as double) as l_extendedprice, "
          f"cast({NET} as double) as net, cast(l_quantity as double) as l_quantity, "
          "cast(l_discount as double) as l_discount, cast(l_tax as double) as l_tax, "
          "cast(p_size as double) as p_size, cast(p_retailprice as double) as p_retailprice, "
          "cast(month(l_shipdate) as double) as ship_month, "
          f"l_returnflag, l_linestatus, o_orderpriority, p_type {_T_BASE}")

C1 = """
select o_orderkey as row_id,
       cast(((substr(o_orderpriority,1,2) = '1-' or substr(o_orderpriority,1,2) = '2-')
             and o_orderstatus <> 'F') or c_mktsegment = 'BUILDING' as integer) as target,
       o_orderpriority, o_orderstatus, c_mktsegment, n_name,
       'Q' || cast(quarter(o_orderdate) as varchar) as o_quarter,
       cast(year(o_orderdate) as varchar) as o_year
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""

M1 = """
select c_custkey as row_id, total_spend, n_orders,
       cast(date_diff('day', last_date, (select max(cast(o_orderdate as date)) from orders)) as double)
         as recency_days,
       cast(c_mktsegment = 'BUILDING' as double) as is_building
from customer join (select o_custkey, sum(o_totalprice) as total_spend, cast(count(*) as double) as n_orders,
                           max(cast(o_orderdate as date)) as last_date
                    from orders group by o_custkey) p on c_custkey = p.o_custkey
"""

L1 = """
select c_custkey as row_id, c_mktsegment as label_a, cast(c_nationkey % 5 as varchar) as label_b,
       spend / 100000.0 as f_spend, cast(cnt as double) as f_orders, c_acctbal / 1000.0 as f_acctbal
from customer join (select o_custkey, sum(o_totalprice) as spend, count(*) as cnt
                    from orders group by o_custkey) p on c_custkey = p.o_custkey
"""

_p1_cols = ", ".join(f"cast(embedding[{i + 1}] as double) as e{i}" for i in range(fx.P1_DIMS))
_p1_proj = " + ".join(f"e{i}" for i in range(8)) + " - (" + " + ".join(f"e{i}" for i in range(8, 16)) + ")"
P1 = f"""
select *, cast(({_p1_proj}) > 0 as integer) as target
from (select vec_id as row_id, cast(label as integer) as label, {_p1_cols} from embeddings) e
"""

_s1_dummies = ", ".join(f"cast(event_type = '{t}' as double) as is_{t}" for t in fx.EVENT_TYPES)
S1 = f"""
select event_id as row_id, ts, cast(hour(ts) as double) as hour,
       cast(json_extract_string(props, '$.k') as double) as k, cast(value as double) as value,
       {_s1_dummies},
       cast((value + cast(json_extract_string(props, '$.k') as double)) > {fx.S1_THRESHOLD} as integer)
         as target
from events
"""

_y1_scores = ", ".join(
    f"floor(({huniform_sql(hkey_sql(0, f'y1m{m}', 'o_orderkey'))} * 0.7 "
    f"+ cast(o_orderstatus = 'F' as integer) * {shift}) * 100 + 0.5) / 100.0 as score_{m}"
    for m, shift in enumerate(fx.Y1_SHIFTS, start=1))
Y1 = f"""
select o_orderkey as row_id, cast(o_orderstatus = 'F' as integer) as y, {_y1_scores}
from orders
"""


def with_(**ctes: str) -> str:
    """``WITH name AS (...), ...`` prefix for an oracle query."""
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in ctes.items()) + "\n"

KR = f"""
select m.row_id, m.total_spend / 100000.0 as target, m.n_orders, m.recency_days, m.is_building,
       c.c_acctbal / 1000.0 as acctbal_k
from ({M1}) m join customer c on m.row_id = c.c_custkey
"""
