"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells, one row for each source, language and topic
that occurs, with its tokens.  Raking then scales the cells to the target
marginals of one dimension after the other, round by round, until they hold.
The fitted weights over the tokens give each cell's sampling rate; a document
is drawn by a hash of its id.

A sample has a size, a share of all tokens, so no cell may be asked for more
than it has.  Targets beyond the tokens of their value are lowered to them and
the others raised in proportion; the raking keeps every cell's weight at or
below its tokens, and what a full cell cannot give the others of its value
give.  So the sample has its size and, where cells allow it at all, the
marginals.  How far they are from the targets is part of the result.

Only DataFrame functions; documents are read twice and only their cells are
shuffled, so a source with a third of all rows is one row per task.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.scratch import materialize

DIMENSIONS = ("source", "lang", "topic")
#: Raking ends when no marginal is farther from its target, or after so many rounds.
TOLERANCE, ROUNDS = 1e-4, 40
#: Default targets are the natural shares to this power, which lifts the small ones.
TEMPER = 0.9
#: Share of the tokens that a sample keeps.
KEEP = 0.7
SEED = "mix"

#: Words of a text.
_WORD = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """What a text is about, told by its form where the table has no topic: from tables and keys to prose of three lengths."""
    n = F.length(F.coalesce(text, F.lit("")))
    return (
        F.when(n == 0, "empty")
        .when(text.contains(" | "), "table")
        .when(text.contains(" = "), "settings")
        .when(text.contains("@"), "contact")
        .when(n < 500, "note")
        .when(n < 5000, "article")
        .otherwise("long read")
    )


def _key(dimension: str) -> Column:
    """The value as text that joins; a null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(dimension).cast("string")), F.lit(""))


def cells(docs: DataFrame) -> DataFrame:
    """Tokens of every combination of the dimensions that occurs; ``k0``, ``k1``, ``k2`` are their keys."""
    keyed = docs.groupBy(*(_key(d).alias(f"k{i}") for i, d in enumerate(DIMENSIONS)))
    return keyed.agg(F.sum("tokens").alias("tokens"))


def tempered(table: DataFrame, dimension: int, power: float = TEMPER) -> DataFrame:
    """Targets ``key``, ``target``: natural shares of the tokens to a power, summing to one."""
    sums = table.groupBy(F.col(f"k{dimension}").alias("key")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("t"))
    total = sums.agg(F.sum("t").alias("s")).first().s or 1.0
    return sums.select("key", (F.col("t") / F.lit(total)).alias("target"))


def given(table: DataFrame, dimension: int, shares: dict) -> DataFrame:
    """Targets from a dictionary of value and share, over the values that occur; others get none."""
    spark = table.sparkSession
    rows = [("" if v is None else f"={v}", float(s)) for v, s in shares.items()]
    wanted = spark.createDataFrame(rows, "key string, target double")
    present = table.where("tokens > 0").select(F.col(f"k{dimension}").alias("key")).distinct().join(wanted, "key")
    present = materialize(present, "targets")
    total = present.agg(F.sum("target").alias("s")).first().s or 1.0
    return present.select("key", (F.col("target") / F.lit(total)).alias("target"))


def rake(
    table: DataFrame, targets: list[DataFrame], size: float | None = None, tolerance: float = TOLERANCE, rounds: int = ROUNDS
) -> tuple[DataFrame, float]:
    """Cells with the fitted ``weight`` (share of the sample), and the largest distance of a marginal from its target.

    A value without target gets 0.  With a ``size`` in tokens no weight exceeds
    the cell's tokens.  Each round scales the weights to every marginal in
    turn; each such step is written, so the plan stays one aggregate and one
    join, and lost executors cost one step.
    """
    total = table.agg(F.sum("tokens").alias("s")).first().s or 1
    limit = F.col("tokens") / F.lit(float(size)) if size else F.lit(float("inf"))
    fitted = table.withColumn("raw", F.col("tokens") / F.lit(float(total))).withColumn("most", limit)
    for i, target in enumerate(targets):
        named = target.select(F.col("key").alias(f"k{i}"), F.col("target").alias(f"t{i}"))
        fitted = fitted.join(named, f"k{i}", "left").withColumn(f"t{i}", F.coalesce(f"t{i}", F.lit(0.0)))
    fitted = materialize(fitted, "raked")
    weight, worst = F.least("raw", "most"), 1.0
    for _ in range(rounds):
        for i in range(len(targets)):
            fitted = materialize(_scaled(fitted, i), "raked")
        worst = _farthest(fitted, len(targets))
        if worst <= tolerance:
            break
    return fitted.withColumn("weight", weight), worst


def _scaled(fitted: DataFrame, i: int) -> DataFrame:
    """One step: the weights of every value of a dimension times what brings their sum to the target.

    Full cells stay full, so a value that lacks something raises the others by
    it; the step is repeated round by round as more cells fill up.
    """
    full, target = F.col("raw") >= F.col("most"), F.col(f"t{i}")
    sums = fitted.groupBy(f"k{i}", f"t{i}").agg(
        F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("full"),
        F.coalesce(F.sum(F.when(~full, F.col("raw"))), F.lit(0.0)).alias("free"),
    )
    now = F.col("full") + F.col("free")
    up = (target - F.col("full")) / F.col("free")
    factor = F.when(now <= 0, 0.0).when((target >= now) & (F.col("free") > 0), up).otherwise(target / now)
    return fitted.join(sums.select(f"k{i}", factor.alias("factor")), f"k{i}").withColumn("raw", F.col("raw") * F.col("factor")).drop("factor")


def _marginals(fitted: DataFrame, dimensions: int) -> DataFrame:
    """``dimension``, ``key``, ``target`` and the sum of the weights ``now``."""
    each = F.array(*(F.struct(F.lit(i).alias("dimension"), F.col(f"k{i}").alias("key"), F.col(f"t{i}").alias("target")) for i in range(dimensions)))
    rows = fitted.select(F.least("raw", "most").alias("weight"), F.explode(each).alias("of")).select("weight", "of.*")
    return rows.groupBy("dimension", "key", "target").agg(F.sum("weight").alias("now"))


def _farthest(fitted: DataFrame, dimensions: int) -> float:
    sums = _marginals(fitted, dimensions)
    return sums.agg(F.max(F.abs(F.col("now") - F.col("target"))).alias("d")).first().d or 0.0


def _reachable(table: DataFrame, i: int, target: DataFrame, size: float) -> DataFrame:
    """Targets of which none asks for more tokens than its value has; the others take the rest in proportion."""
    sums = table.groupBy(F.col(f"k{i}").alias("key")).agg(F.sum("tokens").alias("tokens"))
    wanted = materialize(sums.join(target, "key").select("key", "tokens", F.col("target").alias("weight")), "targets")
    scale = _scale(wanted, size)
    given = F.least(F.col("tokens").cast("double"), F.lit(scale) * F.col("weight")) if scale is not None else F.col("tokens").cast("double")
    return wanted.select("key", (F.when(F.col("weight") > 0, given).otherwise(0.0) / F.lit(float(size))).alias("target"))


def _scale(fitted: DataFrame, budget: float) -> float | None:
    """s with sum of tokens * min(1, s * rate) equal to the budget, or None when all that have a weight are kept.

    Cells are summed by bands of their rate, and the band in which 1 / s lies
    is cut again, a few times; then the cells above it are kept whole and the
    others take the rest.
    """
    rate = F.col("weight") / F.col("tokens")
    used = fitted.where("tokens > 0 and weight > 0").select("tokens", "weight", F.log2(rate).alias("x"))
    facts = used.agg(F.sum("tokens").alias("all"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    if facts.all is None or facts.all <= budget:
        return None
    low, width, full, rest = facts.low, max((facts.high - facts.low) / 256, 1e-12), 0.0, 0.0
    inside = used
    for _ in range(4):
        band = F.floor((F.col("x") - F.lit(low)) / F.lit(width)).cast("int")
        inside = inside.withColumn("band", band)
        sums = {r.band: (r.tokens, r.weight) for r in inside.groupBy("band").agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).collect()}
        below, at = rest + sum(w for _, w in sums.values()), None
        for b in sorted(sums, reverse=True):
            # kept if everything from this band on is kept whole and the rest scaled by the band's lower edge
            tokens, weight = sums[b]
            if full + tokens + (below - weight) / 2 ** (low + b * width) >= budget:
                at = b
                break
            full, below = full + tokens, below - weight
        if at is None:
            return (budget - full) / below if below > 0 else 2.0**-low
        rest = below - sums[at][1]
        inside = inside.where(F.col("band") == at).drop("band")
        low, width = low + at * width, max(width / 256, 1e-15)
    # cells of the last band have practically one rate, at which all of them are cut alike
    return (budget - full) / (rest + sums[at][1])


def _largest(fitted: DataFrame) -> float | None:
    """The largest s at which no s * rate exceeds one, or None when no cell has a weight."""
    return fitted.where("tokens > 0 and weight > 0").agg(F.min(F.col("tokens") / F.col("weight")).alias("s")).first().s


def chance(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 (exclusive) that depends on the id only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def mix(
    docs: DataFrame, shares: dict[str, dict] | None = None, keep: float | None = KEEP, tolerance: float = TOLERANCE, rounds: int = ROUNDS
) -> DataFrame:
    """Probability and decision for every document: ``doc_id``, the dimensions, ``tokens``, ``probability``, ``selected``, ``missed``.

    ``shares`` gives targets by dimension; a dimension that is not in it has
    tempered ones.  The sample has the share ``keep`` of the tokens (or all
    tokens of the values with a target, if they are fewer).  A target that
    asks for more tokens than its value has is lowered to them, and the rest
    goes to the other values in proportion.  ``missed``, the same in every row,
    is the largest difference between a value's expected share of the sample
    and the share that was asked for.  With ``keep`` None the sample is as
    large as all targets allow at once, which the scarcest cell decides.

    Null values of a dimension are a value of their own.  A document without
    tokens has the probability 1 if its cell has no tokens at all, else that
    of the cell.  Repeated rows are drawn together; other columns are ignored;
    an empty table gives an empty result.
    """
    named = [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        topic(F.col("text")).alias("topic"),
        tokens(F.col("text")).alias("tokens"),
    ]
    return _drawn(docs.select(*named), shares or {}, keep, tolerance, rounds)


def _drawn(rows: DataFrame, shares: dict[str, dict], keep: float | None, tolerance: float, rounds: int) -> DataFrame:
    rows = materialize(rows, "measured")
    table = materialize(cells(rows), "cells")
    asked = [given(table, i, shares[d]) if d in shares else tempered(table, i) for i, d in enumerate(DIMENSIONS)]
    usable = table
    for i, target in enumerate(asked):
        usable = usable.join(target.where("target > 0").select(F.col("key").alias(f"k{i}")), f"k{i}", "left_semi")
    held = (table.agg(F.sum("tokens").alias("s")).first().s or 0, usable.agg(F.sum("tokens").alias("s")).first().s or 0)
    if keep is None or not held[1]:
        fitted, _ = rake(table, asked, None, tolerance, rounds)
        scale = _largest(fitted)
        rate = F.lit(scale if scale is not None else 0.0) * F.col("weight") / F.col("tokens")
    else:
        size = min(keep * held[0], held[1])
        fitted, _ = rake(table, [_reachable(usable, i, target, size) for i, target in enumerate(asked)], size, tolerance, rounds)
        rate = F.col("weight") / F.col("most")
    missed = _missed(fitted, asked)
    probability = F.when(F.col("tokens") == 0, 1.0).otherwise(F.least(F.lit(1.0), rate))
    chosen = fitted.select("k0", "k1", "k2", probability.alias("probability"))
    keyed = rows.select("*", *(_key(d).alias(f"k{i}") for i, d in enumerate(DIMENSIONS)))
    joined = keyed.join(chosen, ["k0", "k1", "k2"], "left")
    drawn = (chance(F.col("doc_id")) < F.col("probability")).alias("selected")
    return joined.select("doc_id", *DIMENSIONS, "tokens", "probability", drawn, F.lit(missed).alias("missed"))


def _missed(fitted: DataFrame, asked: list[DataFrame]) -> float:
    """Largest difference between a value's expected share of the sample and what was asked for."""
    sums = _marginals(fitted, len(asked)).select("dimension", "key", "now")
    wanted = reduce(DataFrame.unionByName, [t.select(F.lit(i).alias("dimension"), "key", F.col("target").alias("asked")) for i, t in enumerate(asked)])
    both = sums.join(wanted, ["dimension", "key"], "full_outer").select(F.abs(F.coalesce("now", F.lit(0.0)) - F.coalesce("asked", F.lit(0.0))).alias("d"))
    return float(both.agg(F.max("d").alias("d")).first().d or 0.0)


def select(docs: DataFrame, shares: dict[str, dict] | None = None, keep: float | None = KEEP) -> DataFrame:
    """The documents, with all their columns, that are drawn."""
    drawn = mix(docs, shares, keep).where("selected").select("doc_id").distinct()
    name = "_drawn"
    while name in docs.columns:
        name += "_"
    drawn = drawn.withColumnRenamed("doc_id", name)
    return docs.join(drawn, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi")
