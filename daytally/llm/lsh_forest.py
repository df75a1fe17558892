"""Nearest neighbours by a forest of hash prefixes.

Each tree hashes a vector to a long string of bits, the signs of random
projections.  An index shard holds, per tree, the sorted array of its
strings.  A query descends in every tree to its longest matching prefix and
then ascends in all trees at the same pace, one bit at a time: at each level
the strings that share the prefix are one interval of the sorted array, found
by binary search.  It stops as soon as the intervals hold a wanted share of
the shard, each entry counted once; their members are scored exactly.  A share
of 1 is the whole shard.

How much is wanted depends on the data: clustered vectors need a few
candidates, vectors without structure a good part of the shard.  So the share
is measured: a bounded sample of queries is answered exactly, and the least
share is taken at which the wanted recall is reached on them.

Every query meets every shard, in groups of bounded size: a task holds one
shard and one group, however many there are.

Equal vectors are one entry of the index, with as many of their ids as can be
wanted, so that a common vector is no hot bucket.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daytally.scratch import materialize

TREES = 32
BITS = 24
#: Entries of one shard; its arrays are what a task holds.
SHARD = 16_384
#: Queries that meet a shard in one task, and those answered at a time.
QUERY_GROUP, QUERY_BLOCK = 8_192, 512
#: Queries that are answered exactly to choose the share, at most, and the recall wanted on them.
SAMPLE = 128
WANTED = 0.97
SHARES = (0.01, 0.02, 0.04, 0.08, 0.12, 0.18, 0.25, 0.35, 0.5, 0.7, 1.0)


def valid(vector: str) -> F.Column:
    """Not null, not zero, without null or non-finite components."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def planes(dimensions: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """Random directions, the same for every shard."""
    return np.random.default_rng(20_071).standard_normal((trees * bits, dimensions))


class Shard:
    """Sorted arrays of hash strings of some vectors."""

    def __init__(self, vectors: np.ndarray, directions: np.ndarray, lift: float):
        self.vectors, self.directions = vectors, directions
        # inner products of vectors of unequal length: one more component lifts all to the same length
        rest = np.sqrt(np.maximum(0.0, lift**2 - (vectors**2).sum(axis=1)))
        strings = self.strings(vectors, rest)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, vectors: np.ndarray, rest: np.ndarray | None = None) -> np.ndarray:
        """Hash strings by tree and vector."""
        lifted = np.c_[vectors, np.zeros(len(vectors)) if rest is None else rest]
        bits = (lifted @ self.directions.T > 0).reshape(len(vectors), -1, BITS)
        return (bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))).T.copy()

    def intervals(self, strings: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the prefixes of ``level`` bits lie, by tree and query."""
        shift = BITS - level
        low = (strings >> shift) << shift
        high = low + (np.int64(1) << shift)
        at = lambda x: np.stack([np.searchsorted(s, q) for s, q in zip(self.sorted, x, strict=True)])
        return at(low), at(high)

    def candidates(self, queries: np.ndarray, shares: tuple[float, ...], least: int) -> Iterator[list[np.ndarray]]:
        """For each query, its candidates (without repetition) at each share, ``least`` at least where there are so many."""
        n, strings = len(self.vectors), self.strings(queries)
        bounds = np.array([self.intervals(strings, level) for level in range(BITS, -1, -1)])
        sums = (bounds[:, 1] - bounds[:, 0]).sum(axis=1)
        for q in range(len(queries)):
            found, mark, count, at = [], np.zeros(n, bool), 0, -1
            for share in shares:
                wanted = max(share * n, min(least, n))
                while count < wanted:
                    # trees share entries, so the intervals hold as many as are wanted, or the ascent goes on; the root holds everything
                    at = max(at + 1, int(np.argmax(sums[:, q] >= wanted)))
                    if wanted >= n or at == BITS:
                        mark[:] = True
                    else:
                        for t, order in enumerate(self.order):
                            mark[order[bounds[at, 0, t, q] : bounds[at, 1, t, q]]] = True
                    count = np.count_nonzero(mark)
                found.append(np.flatnonzero(mark))
            yield found


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, wanted: float = WANTED, group: int = QUERY_GROUP
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product with each query, the query's own row left out.

    Both have ``vec_id`` and ``embedding`` (array of numbers); queries are rows
    of ``vectors``.  Result: ``query_id``, ``rank`` (from 1), ``vec_id`` and
    ``score`` (double, exact), nearest first, ties to the smaller id.  Rows
    whose vector is null, zero or has null or non-finite components, or whose
    id is null, take no part; rows with the same id and vector count once; with
    fewer than ``k`` others all are returned.  Vectors have the length that
    most of ``vectors`` have (of two such lengths the larger); those of another
    one take no part, neither as queries.
    """

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        return df.where(valid("embedding") & F.col("vec_id").isNotNull()).distinct()

    same = Window.partitionBy("embedding").orderBy("vec_id")
    lengths = clean(vectors).groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    dimensions = usual.d if usual else 0
    fitting = F.size("embedding") == dimensions
    few = clean(vectors).where(fitting).withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    entries = few.groupBy("embedding").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = materialize(entries, "entries")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    facts = entries.agg(F.count("*").alias("n"), F.max(norm).alias("lift")).first()
    shards = max(1, -(-facts.n // shard))
    lift = facts.lift or 0.0
    asked = clean(queries).where(fitting).groupBy("embedding").agg(F.min("vec_id").alias("query"))
    asked = materialize(asked, "queries")

    def each(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def index(groups: int) -> DataFrame:
        home = F.pmod(F.xxhash64("embedding"), F.lit(shards))
        return entries.select(home.alias("shard"), each(groups).alias("group"), "entry", "embedding")

    def to_shards(df: DataFrame, groups: int) -> DataFrame:
        own = F.pmod(F.xxhash64("query"), F.lit(groups)).alias("group")
        return df.select(each(shards).alias("shard"), own, "query", "embedding")

    def search(shares: tuple[float, ...], exact: bool):
        """For a shard, the best entries of each query; with ``exact``, of all entries, and the share that finds each."""

        def run(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = {"query": [], "entry": [], "score": [], "share": []}
            if len(left) and len(right):
                here = Shard(_matrix(left["embedding"]), planes(dimensions + 1), lift)
                ids = left["entry"].to_numpy()
                for start in range(0, len(right), QUERY_BLOCK):
                    block = right.iloc[start : start + QUERY_BLOCK]
                    asked_for = _matrix(block["embedding"])
                    for q, found in zip(range(len(block)), here.candidates(asked_for, shares, k + 1), strict=True):
                        pool = np.arange(len(ids)) if exact else found[-1]
                        products = (here.vectors if len(pool) == len(ids) else here.vectors[pool]) @ asked_for[q]
                        if len(pool) > k + 1:
                            least = np.partition(products, len(pool) - k - 1)[len(pool) - k - 1]
                            use = products >= least
                            pool, products = pool[use], products[use]
                        best = np.lexsort((ids[pool], -products))[: k + 1]
                        out["query"].append(np.full(len(best), block["query"].iloc[q]))
                        out["entry"].append(ids[pool[best]])
                        out["score"].append(products[best])
                        first = np.full(len(best), np.inf)
                        for share, candidates in reversed(list(zip(shares, found, strict=True))):
                            first[np.isin(pool[best], candidates)] = share
                        out["share"].append(first)
            made = {c: np.concatenate(v) if v else np.empty(0) for c, v in out.items()}
            return pd.DataFrame(made).astype({"query": "int64", "entry": "int64"})

        return run

    def searched(df: DataFrame, shares: tuple[float, ...], exact: bool) -> DataFrame:
        groups = max(1, -(-df.count() // group))
        pairs = index(groups).groupBy("shard", "group").cogroup(to_shards(df, groups).groupBy("shard", "group"))
        return pairs.applyInPandas(search(shares, exact), "query long, entry long, score double, share double")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")

    def top(df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("n", F.row_number().over(best)).where(F.col("n") <= n).drop("n")

    sample = asked.orderBy(F.xxhash64("query"), "query").limit(SAMPLE)
    shares = [r.share for r in top(searched(sample, SHARES, True), k + 1).select("share").collect()]
    enough = [s for s in SHARES if np.mean(np.array(shares) <= s) >= wanted] if shares else [SHARES[0]]
    found = materialize(top(searched(asked, (enough[0],), False), k + 1), "found")

    rows = found.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    nearest_ids = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    rows = rows.withColumn("n", F.row_number().over(nearest_ids)).where(F.col("n") <= k + 1)
    named = clean(queries).join(asked, "embedding").select(F.col("vec_id").alias("query_id"), "query")
    joined = named.join(rows, "query").where("query_id <> vec_id")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return joined.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
