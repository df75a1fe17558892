"""SQL twins of the tree searches and of K-Means, written out level by level and step by step.

Each function gives named steps for ``sql(..., stored=...)``.
"""

from __future__ import annotations

import math

from daytally.ml import splits
from daytally.ml.features import SEED

Steps = list[tuple[str, str]]


def tree(name: str, source: str, dimensions: int, depth: int, looked: bool = False) -> Steps:
    """Steps that grow trees on ``source`` (``key, tree, w, y, x`` with ``x`` a list).

    ``{name}_{level}`` has the rows with their node, ``{name}_splits`` the splits, ``{name}_nodes`` all nodes.
    """
    steps = [(f"{name}_0", f"select key, tree, w, y, x, 1 as node from {source}")]
    for level in range(depth):
        rows, numbers = f"{name}_{level}", ", ".join(map(str, range(dimensions)))
        choice = ""
        if looked:
            count = max(1, math.ceil(dimensions * splits.FEATURE_SHARE))
            choice = f"""where (tree, node, feature) in (select (tree, node, feature) from (
                select tree, node, feature, row_number() over (partition by tree, node
                       order by md5('{SEED}:' || tree || ':' || node || ':' || feature)) as place
                from (select distinct tree, node, feature from long)) where place <= {count})"""
        steps.append((f"{name}_best_{level}", f"""
            with long as (select tree, node, w, y, unnest([{numbers}]) as feature, unnest(x) as value from {rows} where node >= {2**level}),
            by_value as (select tree, node, feature, value, sum(w) as n, sum(w * y) as s from long {choice} group by all),
            sides as (select tree, node, feature, (value + lead(value) over o) / 2 as threshold,
                             sum(n) over o as nl, sum(s) over o as sl,
                             sum(n) over (partition by tree, node, feature) as nt, sum(s) over (partition by tree, node, feature) as st
                      from by_value window o as (partition by tree, node, feature order by value)),
            gains as (select *, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt as gain from sides where threshold is not null)
            select tree, node, feature, threshold from gains where gain > {splits.LEAST_GAIN}
            qualify row_number() over (partition by tree, node order by round(gain, {splits.GAIN_DIGITS}) desc, feature, threshold) = 1"""))
        steps.append((f"{name}_{level + 1}", f"""
            select r.key, r.tree, r.w, r.y, r.x,
                   case when b.feature is null then r.node else 2 * r.node + case when r.x[b.feature + 1] > b.threshold then 1 else 0 end end as node
            from {rows} r left join {name}_best_{level} b on r.tree = b.tree and r.node = b.node"""))
    steps.append((f"{name}_splits", " union all ".join(f"select * from {name}_best_{level}" for level in range(depth))))
    above = "[" + ", ".join(f"node // {2**i}" for i in range(depth + 1)) + "]"
    steps.append((f"{name}_nodes", f"""
        select u.tree, u.node, s.feature, s.threshold, u.n, u.mean
        from (select tree, node, sum(w) as n, sum(w * y) / sum(w) as mean
              from (select tree, w, y, unnest({above}) as node from {name}_{depth}) where node > 0 group by all) u
             left join {name}_splits s on u.tree = s.tree and u.node = s.node"""))
    return steps


def boosted(name: str, source: str, dimensions: int, stages: int, depth: int) -> Steps:
    """Steps that boost trees on ``source``; ``{name}_stage_{i}`` has ``key, x, y, prediction`` after stage ``i``."""
    steps: Steps = []
    rows = f"select key, tree, w, y, x, y as target, cast(0 as double) as prediction from {source}"
    for stage in range(stages):
        this = f"{name}_{stage}"
        steps.append((f"{this}_rows", rows))
        steps += tree(this, f"{this}_rows", dimensions, depth)
        share = 1.0 if stage == 0 else splits.LEARNING_RATE
        steps.append((f"{name}_stage_{stage}", f"""
            select r.key, r.tree, r.w, r.x, r.target, r.prediction + n.mean * {share} as prediction
            from {this}_rows r join {this}_{depth} e on r.key = e.key join {this}_nodes n on e.node = n.node"""))
        rows = f"select key, tree, w, (target - prediction) * {splits.GRADIENT} as y, x, target, prediction from {name}_stage_{stage}"
    return steps


def draws(key: str, tree_: str) -> str:
    """Number of draws of a row for a tree."""
    digest = f"left(md5('{SEED}:' || {tree_} || ':' || {key}), 8)"
    return " + ".join(f"case when {digest} >= '{bound}' then 1 else 0 end" for bound in splits._bounds())


def lloyd(name: str, source: str, dimensions: list[str], k: int, steps: int) -> Steps:
    """K-Means on ``source`` (``key`` and the dimensions): ``{name}_{step}`` has the centres, ``{name}_end`` the rows with theirs."""
    x = [f'"{d}"' for d in dimensions]
    out = [(f"{name}_0", f"""
        select row_number() over (order by md5('{SEED}:' || key), key) - 1 as cluster, {", ".join(f"{c} as c{i}" for i, c in enumerate(x))}
        from {source} qualify cluster < {k}""")]
    distance = " + ".join(f"(p.{c} - c.c{i}) * (p.{c} - c.c{i})" for i, c in enumerate(x))

    def assigned(step: int) -> str:
        return f"""select p.*, c.cluster, {distance} as distance from {source} p, {name}_{step} c
                   qualify row_number() over (partition by p.key order by distance, c.cluster) = 1"""

    for step in range(steps):
        means = ", ".join(f"avg({c}) as m{i}" for i, c in enumerate(x))
        moved = ", ".join(f"coalesce(m.m{i}, c.c{i}) as c{i}" for i in range(len(x)))
        out.append((f"{name}_{step + 1}", f"""
            select c.cluster, {moved} from {name}_{step} c
            left join (select cluster, {means} from ({assigned(step)}) group by cluster) m on c.cluster = m.cluster"""))
    return [*out, (f"{name}_end", assigned(steps))]
