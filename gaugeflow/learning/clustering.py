"""k-means for many settings at once, elbow sweep, PCA, nearest centre, named clusters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import nearest_centre
from ..functions.labels import lookup
from ..operators.ranking import rank_groups
from ..session import ship_package
from ..operators.partials import gather, partial_rows, rows_of

#: Rounds of candidate centres, and candidates per round and centre.
SEED_ROUNDS, OVERSAMPLING = 2, 2


class CentreModel(Transformer, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted centres as a pipeline stage: adds the number of the nearest one, ties to the lowest. Saved and
    loaded like any stage. ``cost`` is the squared distance of all training rows to their centres."""

    centres = Param(Params._dummy(), "centres", "one list of numbers per cluster", TypeConverters.identity)
    cost = Param(Params._dummy(), "cost", "squared distance of the training rows", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the fit", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, centres=None, cost=None, seed=None, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def centre_table(self) -> np.ndarray:
        return np.array(self.getOrDefault(self.centres), dtype=float)

    def clusterCenters(self) -> list[np.ndarray]:
        """The centres, under the name that Spark's own model has for them."""
        return list(self.centre_table())

    def training_cost(self) -> float:
        return self.getOrDefault(self.cost)

    def _transform(self, df: DataFrame) -> DataFrame:
        vector = F.col(self.getFeaturesCol())
        nearest = nearest_centre(F.when(vector.isNotNull(), vector_to_array(vector)), self.getOrDefault(self.centres))
        return df.withColumn(self.getPredictionCol(), nearest.getField("cluster"))


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _content(x: np.ndarray) -> np.ndarray:
    """A hash of each row's numbers."""
    out = np.zeros(len(x), np.uint64)
    for column in np.ascontiguousarray((x + 0.0).T).view(np.uint64):
        out = _mixed(out + column + np.uint64(0x9E3779B97F4A7C15))
    return out


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centre up to a number per row, by one product. Seen from the
    first centre, so that a common offset costs no digits."""
    x, centres = x - centres[0], centres - centres[0]
    return (centres * centres).sum(axis=1) - 2 * (x @ centres.T)


def _draw(models: Sequence[tuple[int, int]], candidates: list[np.ndarray], turn: int):
    """Per model, the rows with the smallest ``-log(u) / d2``: a weighted draw by squared distance to the
    candidates so far. ``u`` is a hash of the row and the seed, so it does not depend on the partitions, and
    equal rows are drawn once."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            x = rows_of(batch)
            if not len(x):
                continue
            content = _content(x)
            for m, (k, seed) in enumerate(models):
                u = (_mixed(content + np.uint64((seed * 1009 + turn + 1) * 7919)) >> np.uint64(11)).astype(float) + 0.5
                d2 = 1.0
                if len(candidates[m]):
                    nearest = _squares(x, candidates[m]).argmin(axis=1)
                    d2 = ((x - candidates[m][nearest]) ** 2).sum(axis=1)
                with np.errstate(divide="ignore"):
                    key = -np.log(u / 2**53) / d2
                take = np.flatnonzero(np.isfinite(key))
                cells = np.column_stack([key, x])[take]
                if len(cells):
                    own = kept.get(m)
                    kept[m] = _smallest(cells if own is None else np.vstack([own, cells]), OVERSAMPLING * k if turn else 1)
        if kept:
            yield partial_rows(kept.items())

    return fold


def _smallest(cells: np.ndarray, n: int) -> np.ndarray:
    _, first = np.unique(cells[:, 0], return_index=True)
    return cells[first[:n]]


def _assign(centres: list[np.ndarray]):
    """Per model, of each centre the sum and number of its rows and their squared distances."""
    edges = np.cumsum([0, *map(len, centres)])
    table = np.vstack(centres)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(table), table.shape[1] + 2))
        for batch in batches:
            rows = rows_of(batch)
            for i in range(0, len(rows), 4096):
                x = rows[i : i + 4096]
                away, own = _squares(x, table), np.zeros((len(x), len(table)))
                for a, b in zip(edges[:-1], edges[1:]):
                    at = away[:, a:b].argmin(axis=1) + a
                    own[np.arange(len(x)), at] = 1
                    total[a:b, -1] += np.bincount(at - a, ((x - table[at]) ** 2).sum(axis=1), b - a)
                total[:, :-2] += own.T @ x
                total[:, -2] += own.sum(axis=0)
        yield partial_rows((m, total[a:b]) for m, (a, b) in enumerate(zip(edges[:-1], edges[1:])))

    return fold


def _seeded(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centres among weighted candidates: drawn one by one by weight and squared distance, then moved
    by a few rounds among the candidates."""
    rng = np.random.default_rng(seed)
    weights = np.maximum(weights, 1e-9)
    centres = candidates[[rng.choice(len(candidates), p=weights / weights.sum())]]
    while len(centres) < k:
        chance = weights * ((candidates[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        if not chance.sum() > 0:
            break  # fewer distinct rows than centres
        centres = np.vstack([centres, candidates[rng.choice(len(candidates), p=chance / chance.sum())]])
    for _ in range(10):
        at = ((candidates[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for c in np.unique(at):
            own = at == c
            centres[c] = np.average(candidates[own], axis=0, weights=weights[own])
    return centres


def fit_many(
    df: DataFrame, models: Sequence[tuple[int, int]], features: str = "features", max_iter: int = 20, tol: float = 1e-4
) -> list[CentreModel]:
    """One k-means fit for each ``(k, seed)``, all of them in the same passes over the rows.

    A pass is one job: each task keeps, per model, the mergeable sums of its rows, and the partial results
    meet in a tree. Candidates for the first centres come from ``SEED_ROUNDS`` weighted draws over all rows
    (two per centre and round), are weighted by the rows nearest to them, and thinned to ``k`` on the driver.
    Then every pass is one iteration of all models that still move by more than ``tol``. Fewer distinct
    rows than ``k`` give fewer centres. Rows with a null or NaN are left out. Fits do not depend on how the
    rows are partitioned, up to rounding. Persist ``df`` when it is costly to read.
    """
    ship_package(df.sparkSession)
    x = df.where(F.col(features).isNotNull()).select(vector_to_array(F.col(features)).alias("x"))
    candidates: list[np.ndarray] = [np.zeros((0, 0))] * len(models)
    for turn in range(SEED_ROUNDS + 1):
        limits = [OVERSAMPLING * k if turn else 1 for k, _ in models]
        width = lambda cells: cells.reshape(-1, d + 1)
        if not turn:
            first = x.where("x IS NOT NULL").select(F.size("x")).first()
            if first is None:
                raise ValueError("no rows to cluster")
            d = first[0]
        drawn = gather(x, _draw(models, candidates, turn), lambda m, parts: _smallest(np.vstack([width(p) for p in parts]), limits[m]))
        if not turn and len(drawn) < len(models):
            raise ValueError("no rows to cluster")
        more = [width(drawn[m])[:, 1:] if m in drawn else np.zeros((0, d)) for m in range(len(models))]
        candidates = [np.vstack([own, new]) if len(own) else new for own, new in zip(candidates, more)]

    def measured(centres: list[np.ndarray]) -> list[np.ndarray]:
        found = gather(x, _assign(centres), lambda m, parts: np.sum(parts, axis=0))
        return [found[m].reshape(-1, d + 2) for m in range(len(centres))]

    weights = [m[:, -2] for m in measured(candidates)]
    centres = [_seeded(c, w, k, seed) for c, w, (k, seed) in zip(candidates, weights, models)]
    cost, moving = [0.0] * len(models), list(range(len(models)))
    for turn in range(max_iter + 1):
        for m, sums in zip(list(moving), measured([centres[m] for m in moving])):
            cost[m] = float(sums[:, -1].sum())  # of the centres that the pass met
            filled = sums[:, -2] > 0
            moved = np.where(filled[:, None], sums[:, :-2] / np.maximum(sums[:, -2:-1], 1), centres[m])
            if turn == max_iter or ((moved - centres[m]) ** 2).sum(axis=1).max() <= tol * tol:
                moving.remove(m)
            else:
                centres[m] = moved
        if not moving:
            break
    return [CentreModel(centres=c.tolist(), cost=v, seed=seed, featuresCol=features) for c, v, (_, seed) in zip(centres, cost, models)]


def fit_kmeans(df: DataFrame, k: int, features: str = "features", seeds: Sequence[int] = (42,)) -> CentreModel:
    """Best of several seeded fits by training cost; see :func:`fit_many`."""
    return min(fit_many(df, [(k, seed) for seed in seeds], features), key=CentreModel.training_cost)


def one_cluster_cost(df: DataFrame, features: str = "features") -> DataFrame:
    """Inertia of a single cluster: the total squared distance to the mean, from one aggregate."""
    measured = df.agg(Summarizer.metrics("variance", "count").summary(F.col(features)).alias("s"))
    variance, n = vector_to_array("s.variance"), F.col("s.count")
    total = F.aggregate(variance, F.lit(0.0), lambda acc, v: acc + v)
    return measured.select((total * (n - 1)).alias("inertia"))


def elbow(
    df: DataFrame, ks: Sequence[int] = range(1, 11), features: str = "features", seeds: Sequence[int] = (42,)
) -> DataFrame:
    """``(k, inertia)`` for each k: the best of the seeds. The input is kept once, and one pass serves an
    iteration of every k and seed."""
    source = df.select(features).persist()
    try:
        models = [(k, seed) for k in ks for seed in (seeds if k > 1 else list(seeds)[:1])]
        fits = fit_many(source, models, features)
    finally:
        source.unpersist()
    rows = {k: min(f.training_cost() for (own, _), f in zip(models, fits) if own == k) for k in ks}
    return df.sparkSession.createDataFrame(sorted(rows.items()), "k int, inertia double")


def project_pca(df: DataFrame, k: int = 2, features: str = "features") -> DataFrame:
    """First ``k`` principal components as ``pc1..``. Input must be centred: Spark's transform does not
    subtract the mean. Signs are made definite by a positive largest loading."""
    model = PCA(k=k, inputCol=features, outputCol="__pca").fit(df)
    loadings = model.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    parts = vector_to_array("__pca")
    out = model.transform(df)
    return out.withColumns({f"pc{i + 1}": F.get(parts, F.lit(i)) * s for i, s in enumerate(signs)}).drop("__pca")


def name_clusters(df: DataFrame, cluster: str, value: str, names: dict[int, str]) -> DataFrame:
    """Add ``rank`` (0.. by ascending mean of ``value``) and ``state`` to rows with a cluster id.

    The ranks, one per cluster of a model, are one map from a scalar subquery, so rows stay where they
    are however uneven the clusters.
    """
    ranks = rank_groups(df, cluster, value).where(F.col(cluster).isNotNull())
    by_cluster = ranks.agg(F.map_from_entries(F.collect_list(F.struct(cluster, "rank")))).scalar()
    fallback = F.concat(F.lit("Cluster "), F.col("rank").cast("string"))
    ranked = df.withColumn("rank", F.try_element_at(by_cluster, F.col(cluster)))
    return ranked.withColumn("state", lookup(F.col("rank"), names, fallback))
