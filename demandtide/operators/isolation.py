"""Isolation forest on windows of a series (Liu, Ting, Zhou 2008).

The forest is one model over all windows it is given. It is small whatever the data:
100 trees of at most 256 windows each. Which tree sees which window is decided by a
hash of the window's place, so the forest does not depend on how the data is split.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandtide.operators.features import norm_params, normalize
from demandtide.operators.numeric import DOUBLES
from demandtide.operators.scores import has_window
from demandtide.operators.series import BLOCK
from demandtide.operators.windows import pack_blocks, unpack_blocks

TREES = 100
SAMPLE = 256
SEED = 42
EULER = 0.5772156649
PRIME = 2147483647  # 2^31 - 1
# Smaller draws count as this one: a logarithm needs more than 0.
LEAST_DRAW = 1e-12
# Candidates drawn per wanted window, so that a tree hardly ever comes up short.
SURPLUS = 1.3


# Blocks scored in one go, so that short series do not pay for each step of each tree.
ABREAST = 8


@dataclass(frozen=True)
class Forest:
    """All nodes of all trees in one row each; both children of a leaf are the leaf itself."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    children: np.ndarray  # left and right child of node k at 2k and 2k + 1
    path: np.ndarray
    depth: int
    norm: float

    def score(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``2 ** (-mean path / norm)`` of the windows of ``values`` that begin at ``starts``.

        Near 1 for windows that are soon alone.
        """
        total = np.zeros(len(starts))
        for root in self.roots:
            at = np.full(len(starts), root)
            for _ in range(self.depth):
                right = values.take(starts + self.feature.take(at)) >= self.cut.take(at)
                at = self.children.take(2 * at + right)
            total += self.path.take(at)
        return 2.0 ** (-(total / len(self.roots)) / self.norm)


def average_path(size: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``size`` leaves."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2 * (math.log(size - 1) + EULER) - 2 * (size - 1) / size


def draw(*parts):
    """A number in [0, 1) fixed by its arguments: whole numbers, or columns of them.

    The parts are lined up modulo a prime and sent through the fifth power, which permutes
    the numbers below that prime. All steps stay within 64 bits, so every engine gets the
    same, and the expression stays small enough to be compiled.
    """
    h = parts[0]
    for part in parts[1:]:
        h = (h * 48271 + part) % PRIME
    square = h * h % PRIME
    return (square * square % PRIME * h + 16807) % PRIME / float(PRIME)


def grow_tree(x: np.ndarray, limit: int, seed: int, tree: int) -> list[dict]:
    """Cut at random until a window is alone or ``limit`` is reached.

    Nodes are numbered as in a heap: 1 is the root, 2k and 2k + 1 are the children of k.
    """
    nodes: list[dict] = []
    waiting = [(np.arange(len(x)), 0, 1)]
    while waiting:
        rows, depth, me = waiting.pop()
        node = {"node": me, "feature": 0, "cut": 0.0, "leaf": True, "path": depth + average_path(len(rows))}
        nodes.append(node)
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            continue
        f = int(usable[int(draw(seed, tree, me, 1) * len(usable))])
        cut = float(low[f] + draw(seed, tree, me, 2) * (high[f] - low[f]))
        # Between two neighbouring floats the draw may be the lower one, which parts nothing.
        node.update(feature=f, cut=cut if cut > low[f] else float(high[f]), leaf=False)
        below = part[:, f] < node["cut"]
        waiting += [(rows[~below], depth + 1, 2 * me + 1), (rows[below], depth + 1, 2 * me)]
    return nodes


def sample_windows(series: DataFrame, keys: Sequence[str], windows: int, length: int, trees: int, sample: int, seed: int) -> DataFrame:
    """``tree, turn, idx, keys``: at most ``sample`` window places per tree.

    About ``SURPLUS * sample * trees`` rows come out, whatever the size of the series. A window draws the
    gap to the next tree that takes it (a geometric number), again and again until the trees are
    through: of many windows nearly all need one draw.
    """
    chance = min(1.0, SURPLUS * sample / windows)
    key = F.pmod(F.xxhash64(*keys), F.lit(PRIME)) if keys else F.lit(0).cast("bigint")
    first = F.lit(seed).cast("bigint")
    missed = math.log(1 - chance) if chance < 1 else -math.inf

    def gap(turn: Column) -> Column:
        if chance >= 1:
            return F.lit(0).cast("bigint")
        return F.floor(F.ln(F.greatest(draw(first, turn, F.col("_key"), F.col("idx"), F.lit(1)), F.lit(LEAST_DRAW))) / F.lit(missed))

    places = series.where(has_window(length)).select(*keys, "idx", key.alias("_key"))
    # The first gap alone decides about most windows, in plain arithmetic.
    some = places.withColumn("_first", gap(F.lit(0).cast("bigint"))).where(F.col("_first") < trees)
    taken = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), F.lit(trees).cast("bigint")),
        F.array("_first"),
        lambda t, k: F.when(F.element_at(t, -1) >= trees, t).otherwise(F.concat(t, F.array(F.element_at(t, -1) + 1 + gap(k)))),
    )
    drawn = some.withColumn("tree", F.explode(F.filter(taken, lambda t: t < trees))).withColumn("tree", F.col("tree").cast("int")).drop("_first")
    turn = draw(first, F.col("tree"), F.col("_key"), F.col("idx"), F.lit(2))
    order = Window.partitionBy("tree").orderBy(turn, *keys, "idx")
    return drawn.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= sample).drop("_key")


def fit_forest(
    series: DataFrame, keys: Sequence[str] = (), value: str = "y", length: int = 24, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> Forest:
    """Grow the trees on the cluster and fetch the finished nodes (at most ``trees * (2*sample-1)`` rows)."""
    keys = list(keys)
    windows = series.where(has_window(length)).count()
    if windows == 0:
        raise ValueError("no series is long enough for a window")
    size = min(sample, windows)
    limit = max(1, math.ceil(math.log2(size)))
    chosen = sample_windows(series, keys, windows, length, trees, sample, seed)
    # The rows of the chosen windows: bounded by trees * sample * length, so safe to broadcast.
    needed = chosen.select(
        "tree", "turn", *keys, F.posexplode(F.sequence(F.col("idx") - (length - 1), F.col("idx"))).alias("place", "idx")
    )
    rows = series.select(*keys, "idx", F.col(value).alias("v")).join(F.broadcast(needed), [*keys, "idx"])
    x = (
        rows.groupBy("tree", "turn")
        .agg(F.sort_array(F.collect_list(F.struct("place", "v"))).alias("r"))
        .select("tree", "turn", F.col("r.v").alias("x"))
    )
    schema = "tree int, node int, feature int, cut double, leaf boolean, path double"

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("turn")
        tree = int(pdf["tree"].iloc[0])
        nodes = grow_tree(np.vstack(pdf["x"].to_numpy()), limit, seed, tree)
        return pd.DataFrame(nodes).assign(tree=tree)[["tree", "node", "feature", "cut", "leaf", "path"]]

    nodes = x.groupBy("tree").applyInPandas(grow, schema).toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
    place = {(t, k): at for at, (t, k) in enumerate(zip(nodes["tree"], nodes["node"]))}
    children = [
        place[t, k] if leaf else place[t, 2 * k + side]
        for t, k, leaf in zip(nodes["tree"], nodes["node"], nodes["leaf"])
        for side in (0, 1)
    ]
    return Forest(
        roots=np.flatnonzero(nodes["node"].to_numpy() == 1),
        feature=nodes["feature"].to_numpy(),
        cut=nodes["cut"].to_numpy(),
        children=np.asarray(children),
        path=nodes["path"].to_numpy(),
        depth=limit,
        norm=max(average_path(size), 1.0),
    )


def forest_scores(
    series: DataFrame, forest: Forest, keys: Sequence[str] = (), value: str = "y", length: int = 24, method: str = "isolation_forest", block: int = BLOCK
) -> DataFrame:
    """Score table: every window scored at its last row, higher is more unusual."""
    keys = list(keys)
    along = ["ts", "y"]
    blocks = pack_blocks(series, keys, value, before=length - 1, block=block, along=along)
    # Plain arrays: unlike functions, broadcast values do not bring their class along.
    shared = series.sparkSession.sparkContext.broadcast(vars(forest))

    def some(values: Sequence[np.ndarray]) -> list[np.ndarray]:
        sizes = np.array([len(v) for v in values])
        made = np.zeros(sizes.sum())
        begin = np.cumsum(sizes) - sizes
        starts = np.concatenate([b + np.arange(max(n - length + 1, 0)) for b, n in zip(begin, sizes)])
        made[starts + length - 1] = Forest(**shared.value).score(np.concatenate(values), starts)
        return np.split(made, begin[1:])

    @F.pandas_udf(DOUBLES)
    def score(values: pd.Series) -> pd.Series:
        return pd.Series([made for lo in range(0, len(values), ABREAST) for made in some(values.iloc[lo : lo + ABREAST].tolist())])

    scored = blocks.withColumn("made", score("values"))
    return unpack_blocks(scored, keys, along, F.col("made"), "score", block).select(
        *keys, F.lit(method).alias("method"), "ts", "idx", "n", "y", "score"
    )


def isolation_forest(
    series: DataFrame, keys: Sequence[str] = (), length: int = 24, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED, value: str = "y"
) -> DataFrame:
    """Fit and score. With keys the series are normalized first, so that large ones do not stand out as such.

    Scaling all values of one series changes nothing for a forest on that series alone.
    """
    if not keys:
        return forest_scores(series, fit_forest(series, (), value, length, trees, sample, seed), value=value, length=length)
    z = normalize(series, norm_params(series, keys), keys).withColumn("z", F.coalesce("z", F.lit(0.0)))
    return forest_scores(z, fit_forest(z, keys, "z", length, trees, sample, seed), keys, "z", length)
