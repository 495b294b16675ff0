"""Isolation forest: a random sample per tree, trees built side by side, rows scored in place.

Liu, Ting, Zhou: Isolation Forest (ICDM 2008).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log, log2

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlab.operators.sampling import sample_n
from textlab.operators.sizing import bounded_rows

EULER = 0.5772156649015329
NODES = "tree int, node int, feature int, threshold double, left int, right int, size int, path_length double"


@dataclass
class IsolationForest:
    """Fitted trees as flat node rows: at most ``trees * (2 * psi - 1)`` of them."""

    nodes: pd.DataFrame
    features: list[str]
    sample_size: int

    def nodes_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODES)

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Add the anomaly score in (0, 1), higher being more anomalous; null without trees."""
        return df.withColumn(name, self._scorer(df.sparkSession)(*[F.col(f).cast("double") for f in self.features]))

    def _scorer(self, spark: SparkSession):
        if self.nodes.empty:
            return lambda *columns: F.lit(None).cast("double")
        import numpy as np

        at = self.nodes.sort_values(["tree", "node"], ignore_index=True)
        roots = np.flatnonzero(at["node"].to_numpy() == 0)
        offset = np.repeat(roots, np.diff(np.r_[roots, len(at)]))
        own = np.arange(len(at))
        leaf = at["feature"].to_numpy() < 0
        forest = spark.sparkContext.broadcast({
            "roots": roots.astype(np.int32),
            "feature": np.where(leaf, 0, at["feature"]).astype(np.int32),
            "threshold": at["threshold"].fillna(0.0).to_numpy(),
            # a leaf leads to itself, so every row can take the same number of steps
            "left": np.where(leaf, own, at["left"].to_numpy() + offset).astype(np.int32),
            "right": np.where(leaf, own, at["right"].to_numpy() + offset).astype(np.int32),
            "path": at["path_length"].to_numpy(),
            "steps": _height(self.sample_size),
            "normal": average_path(self.sample_size),
        })

        @F.pandas_udf("double")
        def anomaly(*columns: pd.Series) -> pd.Series:
            import numpy as np
            import pandas as pd

            f = forest.value
            frame = pd.concat(columns, axis=1, ignore_index=True)
            codes = frame.groupby(list(frame.columns), sort=False, dropna=False).ngroup().to_numpy()
            first = np.unique(codes, return_index=True)[1]
            x = frame.to_numpy(dtype=np.float64)[first]
            scores = np.empty(len(x))
            for start in range(0, len(x), 4096):
                part = x[start:start + 4096]
                row = np.arange(len(part))[None, :]
                at = np.repeat(f["roots"][:, None], len(part), axis=1)
                for _ in range(f["steps"]):
                    goes_left = part[row, f["feature"][at]] <= f["threshold"][at]
                    at = np.where(goes_left, f["left"][at], f["right"][at])
                scores[start:start + 4096] = f["path"][at].mean(axis=0)
            return pd.Series(np.exp2(-scores / max(f["normal"], 1e-12))[codes])

        return anomaly


def average_path(size: int) -> float:
    """Expected path length of an unsuccessful search among ``size`` points, with the harmonic
    number taken as ln(i) + Euler's constant."""
    if size < 2:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (log(size - 1) + EULER) - 2.0 * (size - 1) / size


def _height(size: int) -> int:
    return max(1, ceil(log2(max(size, 2))))


def fit_isolation_forest(
    df: DataFrame, features: Sequence[str], key: Sequence[str], trees: int = 100, psi: int = 256, seed: int = 42
) -> IsolationForest:
    """Fit ``trees`` trees of up to ``psi`` rows each.

    An exact sample of up to ``trees * psi`` rows is put in a random order and dealt out in turn, from the
    start again whenever it ends: no row comes twice to a tree, and trees share rows only where there
    are fewer rows than they need. Rows are chosen by hashes of ``key``; the work after the sample does not
    depend on the size of ``df``.
    """
    features = list(features)
    wanted = trees * psi
    pool = bounded_rows(sample_n(df.select(*key, *features), wanted, key, seed), wanted)
    if pool is None:
        raise ValueError(f"{list(key)} does not identify rows")
    n = pool.count()
    size = min(psi, n)
    # One window over a sample of bounded size.
    order = F.row_number().over(Window.orderBy(F.xxhash64(*key, F.lit(seed)), *key)).cast("long") - 1
    dealt = F.expr(f"sequence(_at, {trees * size - 1}L, {n}L)") if n else F.array().cast("array<bigint>")
    drawn = pool.withColumn("_at", order).withColumn("_at", F.explode(dealt)).withColumns({
        "tree": F.floor(F.col("_at") / max(size, 1)).cast("int"), "_nth": F.col("_at") % max(size, 1),
    })
    draws = drawn.select("tree", "_nth", *[F.col(f).cast("double").alias(f) for f in features])
    table = average_path_table(psi)
    height = _height(psi)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        import pandas as pd

        tree = int(rows["tree"].iloc[0])
        data = rows.sort_values("_nth")[features].to_numpy(dtype=np.float64)
        rng = np.random.default_rng([seed, tree])
        limit = min(height, max(1, int(np.ceil(np.log2(max(len(data), 2))))))
        out: list[list] = []
        open_nodes = [(data, 0, None, None)]
        while open_nodes:
            part, depth, parent, side = open_nodes.pop()
            node = len(out)
            if parent is not None:
                out[parent][side] = node
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(part) <= 1 or len(usable) == 0:
                out.append([tree, node, -1, None, -1, -1, len(part), depth + table[len(part)]])
                continue
            feature = int(rng.choice(usable))
            threshold = float(rng.uniform(low[feature], high[feature]))
            goes_left = part[:, feature] <= threshold
            out.append([tree, node, feature, threshold, -1, -1, len(part), float(depth)])
            open_nodes.append((part[~goes_left], depth + 1, node, 5))
            open_nodes.append((part[goes_left], depth + 1, node, 4))
        return pd.DataFrame(
            out, columns=["tree", "node", "feature", "threshold", "left", "right", "size", "path_length"]
        )

    nodes = draws.groupBy("tree").applyInPandas(grow, NODES).toPandas()
    return IsolationForest(nodes, features, int(nodes["size"].max()) if len(nodes) else 0)


def average_path_table(psi: int) -> list[float]:
    return [average_path(i) for i in range(psi + 1)]
