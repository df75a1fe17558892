"""Shared pieces of the SQL twins.

``sql(body, *names)`` puts the named common table expressions, with those they
need, in front of a query.  The text is written independently of the Spark
code: window functions where Spark aggregates, subqueries where Spark stores an
intermediate table.
"""

from __future__ import annotations

from daytally.operators.series import MEASURES

CTES: dict[str, tuple[list[str], str]] = {
    "incidents": ([], """
        select l_orderkey as id, l_linenumber as case_no, l_shipdate as ts, year(l_shipdate) as yr,
               p_brand as primary_type, n_name as location,
               l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
        from lineitem join part on l_partkey = p_partkey
                      join supplier on l_suppkey = s_suppkey
                      join nation on s_nationkey = n_nationkey"""),
    "deduped": (["incidents"], """
        select * exclude (rn) from (
          select *, row_number() over (partition by id, case_no order by ts, l_partkey, l_suppkey, l_quantity,
                 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) as rn
          from incidents) where rn = 1"""),
    "kept": (["deduped"], "select *, cast(ts as date) as date from deduped where yr is null or yr <= 1999"),
    "type_freq": (["kept"], """
        select primary_type as category, count(*) as n,
               row_number() over (order by count(*) desc, primary_type) as pos
        from kept where primary_type is not null group by primary_type"""),
    "location_freq": (["kept"], """
        select location as category, count(*) as n,
               row_number() over (order by count(*) desc, location) as pos
        from kept where location is not null group by location"""),
    "bucketed": (["kept", "type_freq", "location_freq"], """
        select k.date, k.ts, k.id,
               case when k.primary_type is null then null when t.pos <= 20 then k.primary_type else 'OTHER' end as primary_type,
               case when k.location is null then null when l.pos <= 20 then k.location else 'OTHER' end as location
        from kept k left join type_freq t on k.primary_type = t.category
                    left join location_freq l on k.location = l.category"""),
    "long_counts": (["bucketed"], """
        select date, 'Type' as dimension, primary_type as category, count(*) as n
        from bucketed where primary_type is not null group by all
        union all
        select date, 'Location', location, count(*) from bucketed where location is not null group by all"""),
    "totals": (["bucketed"], """
        select date, count(primary_type) as total from bucketed group by date
        having count(primary_type) > 0 and count(location) > 0"""),
    "wide_rows": (["long_counts", "totals"], """
        select cast(l.date as varchar) as date, l.dimension || ': ' || l.category as category, l.n
        from long_counts l join totals t on l.date = t.date
        union all
        select cast(date as varchar), 'Total Crimes', total from totals"""),
    "obs": ([], """
        select date, cast(f - o as double) as "Depart", cast(urgent as double) as "Heat",
               cast((200 * low + n) // (2 * n) as double) / 100 as "PrecipTotal",
               cast((2 * cents + 100 * n) // (200 * n) as double) / 1000 as "Tavg", hi / 1000 as "Tmax", lo / 1000 as "Tmin"
        from (select cast(o_orderdate as date) as date, count(*) as n,
                     sum(cast(floor(o_totalprice * 100 + 0.5) as bigint)) as cents,
                     max(o_totalprice) as hi, min(o_totalprice) as lo,
                     count(*) filter (o_orderpriority = '1-URGENT') as urgent,
                     count(*) filter (o_orderpriority = '5-LOW') as low,
                     count(*) filter (o_orderstatus = 'F') as f,
                     count(*) filter (o_orderstatus = 'O') as o
              from orders group by 1)"""),
    "days": (["obs", "totals"], """
        select obs.*, cast(total as double) as y from obs join totals on obs.date = totals.date"""),
}


def _needed(names) -> list[str]:
    out: list[str] = []
    for name in names:
        for n in [*_needed(CTES[name][0]), name]:
            if n not in out:
                out.append(n)
    return out


def sql(body: str, *names: str, extra: list[tuple[str, str]] | None = None, stored: list[tuple[str, str]] | None = None) -> str:
    """``stored`` expressions are worked out once, however often they are read."""
    parts = [(n, CTES[n][1]) for n in _needed(names)] + (extra or [])
    texts = [f"{n} as ({text})" for n, text in parts] + [f"{n} as materialized ({text})" for n, text in stored or []]
    return "with " + ",\n".join(texts) + "\n" + body


# Sort key and date parts of a column named ``date``.
PARTS = """
cast((year(date) % 100) * 10000 + month(date) * 100 + day(date) as bigint) as "Date", cast(year(date) as bigint) as "Year",
cast(month(date) as bigint) as "Month", cast(day(date) as bigint) as "Day"
"""

# Six measures rounded the way the Spark side rounds them.
ROUNDED = ", ".join(f'round("{m}", 6) as "{m}"' for m in MEASURES)


def counts_text(source: str, day: str = "date") -> str:
    """One text per day with every category of ``(date, category, n)`` rows and its count, zeros included, by name."""
    return f"""
select {day}, string_agg(c.category || '=' || cast(coalesce(r.n, 0) as bigint), ';' order by c.category) as counts
from (select distinct date from {source}) d cross join (select distinct category from {source}) c
     left join (select date, category, sum(n) as n from {source} group by all) r on r.date = d.date and r.category = c.category
group by d.date"""


def ridge(source: str = "days", name: str = "ridge", reg_param: float = 0.3) -> list[tuple[str, str]]:
    """Closed form of the linear model on the rows of ``source`` by Gauss-Jordan elimination.

    The penalty of a standardised fit is ``reg_param / std(y)`` times the
    variance of each measure on the diagonal of their covariance matrix.  Ends
    in ``name`` with one row: ``b1`` to ``b6`` and ``b0``.
    """
    k = len(MEASURES)
    x = [f'"{m}"' for m in MEASURES]
    cells = []
    for i in range(k):
        for j in range(k):
            extra = f" + {reg_param} / stddev_pop(y) * var_pop({x[i]})" if i == j else ""
            cells.append(f"covar_pop({x[i]}, {x[j]}){extra} as a{i + 1}_{j + 1}")
        cells.append(f"covar_pop({x[i]}, y) as a{i + 1}_{k + 1}")
    means = ", ".join(f"avg({x[i]}) as m{i + 1}" for i in range(k)) + ", avg(y) as m0"
    steps = [(f"{name}_0", f"select {', '.join(cells)}, {means} from {source}")]
    keep = ", ".join(f"m{i}" for i in range(k + 1))
    for p in range(1, k + 1):
        row = []
        for i in range(1, k + 1):
            for j in range(p + 1, k + 2):
                pivot = f"a{p}_{j} / a{p}_{p}"
                row.append(f"{pivot} as a{p}_{j}" if i == p else f"a{i}_{j} - a{i}_{p} * {pivot} as a{i}_{j}")
        steps.append((f"{name}_{p}", f"select {', '.join(row)}, {keep} from {name}_{p - 1}"))
    b = ", ".join(f"a{i}_{k + 1} as b{i}" for i in range(1, k + 1))
    b0 = "m0 - (" + " + ".join(f"a{i}_{k + 1} * m{i}" for i in range(1, k + 1)) + ")"
    steps.append((name, f"select {b}, {b0} as b0 from {name}_{k}"))
    return steps


RIDGE_PREDICTION = " + ".join(["b0", *[f'b{i + 1} * "{m}"' for i, m in enumerate(MEASURES)]])
