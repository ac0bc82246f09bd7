"""Feature operators and estimators."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from .. import presets
from ..functions.arrays import nearest_centre
from ..functions.labels import lookup
from ..learning import clustering, comparison, moments, pca, pipelines, scaling, split
from ..operators import filters, scoring, stats
from ..operators.quality import binarise_by_median
from ..plans import predict
from ..session import scratch_dir
from .aggregates import predicted_prices
from .registry import CHANNELS, WEEKLY, query, rounded, table, weekly

LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
PRICE = "l_extendedprice"
DIMS = [f"e{i}" for i in range(64)]
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in CHANNELS)


@query("f8_skip_invalid_features", f"WITH {WEEKLY} SELECT reading_id, {', '.join(f'round({c}, 8) AS {c}' for c in CHANNELS)} FROM weekly WHERE {COMPLETE}")
def f8(spark, sf):
    vectors = pipelines.assembler(CHANNELS).transform(weekly(spark, sf).select("reading_id", *CHANNELS))
    cells = pipelines.plain_vectors(vectors.select("reading_id", "raw_features"))
    return cells.select("reading_id", *[F.round(F.get("raw_features", F.lit(i)), 8).alias(c) for i, c in enumerate(CHANNELS)])


@query("l1_vector_assembly", "SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax, 6) AS total FROM lineitem")
def l1(spark, sf):
    vectors = pipelines.plain_vectors(pipelines.assembler(LINE_FEATURES).transform(table(spark, sf, "lineitem")))
    total = F.aggregate("raw_features", F.lit(0.0), lambda acc, x: acc + x)
    return vectors.select("l_orderkey", "l_linenumber", F.round(total, 6).alias("total"))


def _standard_sql(deviation):
    parts = ", ".join(f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT {deviation}({c}) FROM lineitem), 6) AS {c}" for c in LINE_FEATURES)
    return f"SELECT l_orderkey, l_linenumber, {parts} FROM lineitem"


@query("l2_standardise_sample", _standard_sql("stddev_samp"))
def l2(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_FEATURES)
    return rounded(scaling.standardise(lines, LINE_FEATURES, ddof=1), *LINE_FEATURES)


@query("l2_standardise_population", _standard_sql("stddev_pop"))
def l2_population(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_FEATURES)
    return rounded(scaling.standardise(lines, LINE_FEATURES, ddof=0), *LINE_FEATURES)


def _hash_sql(key, buckets, offset=0):
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR)), {offset + 1}, 8))::BIGINT % {buckets})"


@query("l3_hash_split", f"SELECT o_orderkey, CASE WHEN {_hash_sql('o_orderkey', 100)} < 80 THEN 'train' ELSE 'test' END AS part FROM orders")
def l3(spark, sf):
    train, test = split.hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("l4_least_squares", f"SELECT 'l_quantity' AS feature, round(regr_slope({PRICE}, l_quantity), 4) AS coefficient FROM lineitem UNION ALL SELECT '(intercept)', round(regr_intercept({PRICE}, l_quantity), 4) FROM lineitem")
def l4(spark, sf):
    model = _one_feature_model(spark, sf)
    return rounded(pipelines.coefficients(spark, model).select("feature", "coefficient"), "coefficient", digits=4)


def _one_feature_model(spark, sf):
    pipeline = pipelines.pipeline(["l_quantity"], pipelines.least_squares(PRICE), standardised=False)
    return pipeline.fit(table(spark, sf, "lineitem"))


@query(
    "l4_least_squares_all_features",
    """SELECT CAST(position AS INTEGER) AS position, feature, CAST(coefficient AS DOUBLE) AS coefficient FROM
       (VALUES (0, 'l_quantity', 2), (1, 'l_discount', -500), (2, 'l_tax', 700), (3, '(intercept)', 3)) t(position, feature, coefficient)""",
)
def l4_all(spark, sf):
    """A target that is linear in all features gives back its coefficients."""
    target = F.lit(3.0) + F.col("l_quantity") * 2 - F.col("l_discount") * 500 + F.col("l_tax") * 700
    pipeline = pipelines.pipeline(LINE_FEATURES, pipelines.least_squares("target"), standardised=False)
    model = pipeline.fit(table(spark, sf, "lineitem").withColumn("target", target))
    return rounded(pipelines.coefficients(spark, model), "coefficient", digits=4)


PENALTIES, MIXES = (0.01, 0.1), (0.0, 0.5)
KEYED = f"""z AS (SELECT CAST({_hash_sql("(l_orderkey || '-' || l_linenumber)", 3, 8)} AS INTEGER) AS fold, {PRICE} AS y, l_quantity AS a, l_discount AS b, l_tax AS c FROM lineitem)"""


def _net_sql(penalties, mixes):
    """Coordinate descent on the correlations of the rows outside each fold, as a recursive query: table
    ``fitted`` with weights per fold and setting, table ``errors`` with the left-out error."""
    pull = {"a": ("b", "c"), "b": ("a", "c"), "c": ("a", "b")}
    steps, fresh = [], set()
    for j, others in pull.items():
        rest = " - ".join(f"r_{''.join(sorted(j + o))} * {'n' if o in fresh else 'w'}{o}" for o in others)
        steps.append(f"sign(r_{j}y - {rest}) * greatest(abs(r_{j}y - {rest}) - l1, 0) / (1 + l2) AS n{j}")
        fresh.add(j)
    moments = ", ".join([f"avg({c}) AS m{c}, stddev_pop({c}) AS s{c}" for c in "yabc"] + [f"corr({i}, {j}) AS r_{i}{j}" for i, j in ("ay", "by", "cy", "ab", "ac", "bc")])
    grid = ", ".join(f"({p}, {m})" for p in penalties for m in mixes)
    line = " + ".join(f"w{j} * ({j} - m{j}) / s{j}" for j in "abc")
    return f"""{KEYED},
      g AS (SELECT *, penalty * mix / sy AS l1, penalty * (1 - mix) / sy AS l2 FROM
        (SELECT left_out, {moments} FROM z JOIN (SELECT DISTINCT fold AS left_out FROM z) f ON fold <> left_out GROUP BY left_out),
        (VALUES {grid}) t(penalty, mix)),
      descent AS (SELECT left_out, penalty, mix, 0 AS i, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc FROM g
        UNION ALL SELECT left_out, penalty, mix, i + 1, na, nb, nc FROM
          (SELECT left_out, penalty, mix, i, {', '.join(steps)} FROM descent JOIN g USING (left_out, penalty, mix) WHERE i < 40)),
      errors AS (SELECT left_out, penalty, mix, sqrt(avg(pow(y - my - sy * ({line}), 2))) AS rmse
        FROM z JOIN g ON fold = left_out JOIN (SELECT * FROM descent WHERE i = 40) USING (left_out, penalty, mix) GROUP BY ALL)"""


def _net_search(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    folded = split.with_fold(lines.select("key", PRICE, *LINE_FEATURES), "key", 3)
    return moments.search(folded, LINE_FEATURES, PRICE, "fold", PENALTIES, MIXES)


@query(
    "l5_elastic_net_search",
    f"WITH RECURSIVE {_net_sql(PENALTIES, MIXES)} SELECT CAST(penalty AS DOUBLE) AS reg_param, CAST(mix AS DOUBLE) AS elastic_net, round(avg(rmse), 2) AS cv_rmse FROM errors GROUP BY penalty, mix",
)
def l5(spark, sf):
    rows = [(s.penalty, s.mix, s.rmse) for s in _net_search(spark, sf)]
    return rounded(spark.createDataFrame(rows, "reg_param double, elastic_net double, cv_rmse double"), "cv_rmse", digits=2)


@query(
    "l13_parameter_grid",
    f"""WITH RECURSIVE {_net_sql(PENALTIES, MIXES)} SELECT CAST(dense_rank() OVER (ORDER BY penalty, mix) - 1 AS INTEGER) AS setting,
        CAST(penalty AS DOUBLE) AS reg_param, CAST(mix AS DOUBLE) AS elastic_net, left_out AS fold, round(rmse, 4) AS rmse FROM errors""",
)
def l13(spark, sf):
    """The grid as a table: each setting's error on each left-out fold."""
    rows = [(i, s.penalty, s.mix, fold, e) for i, s in enumerate(_net_search(spark, sf)) for fold, e in enumerate(s.fold_rmse)]
    return rounded(spark.createDataFrame(rows, "setting int, reg_param double, elastic_net double, fold int, rmse double"), "rmse", digits=4)


GIVEN = (1500.0, -200.0, 300.0), 100.0


@query(
    "l5_fold_errors",
    f"WITH {KEYED} SELECT fold, count(*) AS n, round(sqrt(avg(pow(y - ({GIVEN[1]} + a * {GIVEN[0][0]} + b * {GIVEN[0][1]} + c * {GIVEN[0][2]}), 2))), 4) AS rmse FROM z GROUP BY fold",
)
def l5_errors(spark, sf):
    """Error of given coefficients on each fold, from the fold's moments alone."""
    lines = table(spark, sf, "lineitem").withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    folds = moments.fold_moments(split.with_fold(lines.select("key", PRICE, *LINE_FEATURES), "key", 3), LINE_FEATURES, PRICE, "fold")
    rows = [(fold, int(m.n), (moments.squared_error(m, *GIVEN) / m.n) ** 0.5) for fold, m in folds.items()]
    return rounded(spark.createDataFrame(rows, "fold int, n long, rmse double"), "rmse", digits=4)


def _grouped_events(spark, sf, group):
    """Events with features ``f0`` to ``f3`` that each tell the groups apart by a wide gap."""
    shift = group.cast("double") * 100
    return table(spark, sf, "events").select("event_id", "user_id", *[(shift + F.col("event_id") % (i + 2)).alias(f"f{i}") for i in range(4)])


GROUP_FEATURES = [f"f{i}" for i in range(4)]


@query(
    "l6_forest_regression",
    f"SELECT event_id, CAST(user_id % 4 * 10 AS DOUBLE) AS target, CAST(user_id % 4 * 10 AS DOUBLE) AS prediction FROM events WHERE {_hash_sql('event_id', 100)} >= 80",
)
def l6(spark, sf):
    """Every leaf holds one target."""
    group = F.col("user_id") % 4
    rows = _grouped_events(spark, sf, group).withColumn("target", group.cast("double") * 10)
    train, test = split.hash_split(rows, "event_id")
    model = pipelines.pipeline(GROUP_FEATURES, pipelines.forest_regressor("target", numTrees=100, maxDepth=10)).fit(pipelines.dealt(train, "event_id"))
    return model.transform(test).select("event_id", "target", F.round("prediction", 4).alias("prediction"))


def _labelled_vectors(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"), "embedding")
    return vectors.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>"))).drop("embedding")


def _shifted(spark, sf, shift):
    """Vectors whose element ``i`` is ``shift(x, i)``: what makes the right answer definite."""
    moved = F.transform(F.col("embedding").cast("array<double>"), shift)
    return table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"), moved.alias("embedding"))


def _with_vectors(rows):
    return rows.withColumn("features", array_to_vector("embedding")).drop("embedding")


TOLD_APART = f"SELECT vec_id, CAST(label AS INTEGER) AS label, CAST(label AS INTEGER) AS prediction FROM embeddings WHERE {_hash_sql('vec_id', 100)} >= 80"


@query("l7_forest_classification", TOLD_APART)
def l7(spark, sf):
    """Every element tells all classes apart by a wide gap."""
    train, test = split.hash_split(_with_vectors(_shifted(spark, sf, lambda x: F.col("label") * 10 + F.signum(x))), "vec_id")
    model = pipelines.forest_classifier("label").fit(pipelines.dealt(train, "vec_id"))
    return model.transform(test).select("vec_id", F.col("label").cast("int"), F.col("prediction").cast("int"))


@query("l8_logistic_regression", TOLD_APART)
def l8(spark, sf):
    """Each class stands out in elements of its own."""
    far = _shifted(spark, sf, lambda x, i: x + F.when(i % 10 == F.col("label"), 100.0).otherwise(0.0))
    train, test = split.hash_split(_with_vectors(far), "vec_id")
    model = pipelines.logistic("label", train.count()).fit(train)
    return model.transform(test).select("vec_id", F.col("label").cast("int"), F.col("prediction").cast("int"))


@query("l9_kmeans", "SELECT vec_id, CAST(vec_id % 4 AS INTEGER) AS cluster FROM embeddings")
def l9(spark, sf):
    """Four far groups; clusters are numbered by their mean."""
    group = (F.col("vec_id") % 4).cast("double")
    vectors = _shifted(spark, sf, lambda x: group * 1000 + x).withColumn("at", F.get("embedding", F.lit(0)))
    vectors = _with_vectors(vectors).persist()
    try:
        model = clustering.fit_kmeans(vectors, 4, seeds=range(42, 52))
    finally:
        vectors.unpersist()
    found = model.transform(vectors).withColumnRenamed("prediction", "found")
    return clustering.name_clusters(found, "found", "at", presets.CLUSTER_NAMES).select("vec_id", F.col("rank").alias("cluster"))


@query(
    "l10_elbow",
    """WITH p AS (SELECT pow(10, vec_id % 4) AS x FROM embeddings),
         parts AS (SELECT k, var_pop(x) * count(*) AS v FROM p, (VALUES (1), (2), (3)) t(k)
           GROUP BY k, CASE k WHEN 1 THEN 0 WHEN 2 THEN CASE WHEN x = 1000 THEN 1 ELSE 0 END ELSE CASE WHEN x <= 10 THEN 0 ELSE x END END)
       SELECT CAST(k AS INTEGER) AS k, round(64 * sum(v), 3) AS inertia FROM parts GROUP BY k
       UNION ALL SELECT CAST(range AS INTEGER), 0.0::DOUBLE FROM range(4, 11)""",
)
def l10(spark, sf):
    """Four distinct points, each ten times as far as the one before."""
    at = F.pow(F.lit(10.0), F.col("vec_id") % 4)
    vectors = _with_vectors(_shifted(spark, sf, lambda x: at))
    return rounded(clustering.elbow(vectors, seeds=range(42, 52)), "inertia", digits=3)


VECTOR_CELLS = "SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings"


@query("l10_single_cluster_cost", f"SELECT round(sum(v), 4) AS inertia FROM (SELECT var_pop(x) * count(*) AS v FROM ({VECTOR_CELLS}) GROUP BY i)")
def l10_one(spark, sf):
    return rounded(clustering.one_cluster_cost(_labelled_vectors(spark, sf)), "inertia", digits=4)


@query(
    "l11_pca",
    """WITH w AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[1]::DOUBLE + embedding[2]::DOUBLE AS b FROM embeddings),
         s AS (SELECT vec_id, (a - avg(a) OVER ()) / stddev_samp(a) OVER () AS a, (b - avg(b) OVER ()) / stddev_samp(b) OVER () AS b FROM w),
         r AS (SELECT corr(a, b) AS r FROM s)
       SELECT vec_id, round(abs(CASE WHEN r > 0 THEN a + b ELSE a - b END) / sqrt(2), 4) AS pc1,
         round(abs(CASE WHEN r > 0 THEN a - b ELSE a + b END) / sqrt(2), 4) AS pc2 FROM s, r""",
)
def l11(spark, sf):
    """Two standardised columns have their sum and their difference as components, up to the sign."""
    wide = pipelines.with_features(table(spark, sf, "embeddings"), "embedding", DIMS[:2]).withColumn("e1", F.col("e0") + F.col("e1"))
    scaled = Pipeline(stages=[pipelines.assembler(DIMS[:2]), pipelines.scaler()]).fit(wide).transform(wide)
    found = clustering.project_pca(scaled)
    return found.select("vec_id", *[F.round(F.abs(F.col(c)), 4).alias(c) for c in ("pc1", "pc2")])


@query(
    "l11_pca_all",
    f"""WITH cells AS ({VECTOR_CELLS}), s AS (SELECT i, avg(x) AS m, stddev_samp(x) AS d FROM cells GROUP BY i)
        SELECT vec_id, round(sum(pow((x - m) / d, 2)), 4) AS norm2, 64.0::DOUBLE AS total, true AS falling, true AS orthonormal, 0.0::DOUBLE AS mixed
        FROM cells JOIN s USING (i) GROUP BY vec_id""",
)
def l11_all(spark, sf):
    """All components of all 64 standardised columns: a rotation, so a row keeps its length, and the
    coordinates have the variances of the components and no correlation."""
    wide = pipelines.with_features(table(spark, sf, "embeddings"), "embedding", DIMS)
    scaled = Pipeline(stages=[pipelines.assembler(DIMS), pipelines.scaler()]).fit(wide).transform(wide).select("vec_id", "features")
    found = pca.fit_components(scaled, 64)
    d, v = found.directions, found.variances
    rows = pca.project(scaled, found)
    pairs = [(0, 1), (1, 2), (10, 40), (62, 63)]
    mixed = rows.agg(F.greatest(*[F.abs(F.corr(F.get("pc", F.lit(i)), F.get("pc", F.lit(j)))) for i, j in pairs])).scalar()
    norm2 = F.aggregate("pc", F.lit(0.0), lambda acc, c: acc + c * c)
    return rows.select(
        "vec_id", F.round(norm2, 4).alias("norm2"), F.lit(round(float(v.sum()), 6)).alias("total"), F.lit(bool((v[:-1] >= v[1:]).all())).alias("falling"),
        F.lit(bool(abs(d.T @ d - np.eye(64)).max() < 1e-9)).alias("orthonormal"), F.round(mixed, 6).alias("mixed"),
    )


@query("l12_fold_sizes", f"SELECT CAST({_hash_sql('o_orderkey', 3, 8)} AS INTEGER) AS fold, count(*) AS n FROM orders GROUP BY 1")
def l12(spark, sf):
    folded = split.with_fold(table(spark, sf, "orders"), "o_orderkey", 3)
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("l14_coefficients", f"SELECT CAST(0 AS INTEGER) AS position, 'l_quantity' AS feature, round(regr_slope({PRICE}, l_quantity) * stddev_samp(l_quantity), 3) AS coefficient FROM lineitem UNION ALL SELECT 1, '(intercept)', round(avg({PRICE}), 3) FROM lineitem")
def l14(spark, sf):
    pipeline = pipelines.pipeline(["l_quantity"], pipelines.least_squares(PRICE))
    return rounded(pipelines.coefficients(spark, pipeline.fit(table(spark, sf, "lineitem"))), "coefficient", digits=3)


@query("l15_feature_importances", "SELECT 'e0' AS first, 1.0::DOUBLE AS total, 64::BIGINT AS features")
def l15(spark, sf):
    """One feature tells all classes apart; importances sum to one."""
    wide = pipelines.with_features(table(spark, sf, "embeddings"), "embedding", DIMS)
    wide = wide.withColumn("e0", F.col("label") * 10 + F.signum("e0"))
    model = pipelines.pipeline(DIMS, pipelines.forest_classifier("label")).fit(pipelines.dealt(wide, "vec_id"))
    found = pipelines.importances(spark, model)
    return found.agg(F.max_by("feature", "importance").alias("first"), F.round(F.sum("importance"), 6).alias("total"), F.count("feature").alias("features"))


@query(
    "l16_named_clusters",
    """WITH c AS (SELECT event_id, CAST(user_id % 4 AS INTEGER) AS cluster, value FROM events),
       r AS (SELECT cluster, CAST(row_number() OVER (ORDER BY avg(value), cluster) - 1 AS INTEGER) AS rank FROM c GROUP BY cluster)
       SELECT event_id, cluster, rank, CASE rank WHEN 0 THEN 'Clean' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High' ELSE 'Severe' END AS state FROM c JOIN r USING (cluster)""",
)
def l16(spark, sf):
    given = table(spark, sf, "events").select("event_id", (F.col("user_id") % 4).cast("int").alias("cluster"), "value")
    return clustering.name_clusters(given, "cluster", "value", presets.CLUSTER_NAMES).drop("value")


def measured_models(spark, sf):
    """Long metric table of two closed-form predictors of the line price."""
    lines = predicted_prices(spark, sf)
    flat = lines.withColumn("prediction", F.lit(40000.0))
    out = None
    for i, (name, frame) in enumerate((("LinearRegression", lines), ("RandomForestRegressor", flat))):
        m = stats.regression_metrics(frame, PRICE, "prediction")
        cells = [
            F.struct(F.lit(name).alias("model"), F.lit(i).alias("ordinal"), F.lit(k).alias("metric"), F.col(k).alias("value"), F.lit(better).alias("higher_better"))
            for k, better in comparison.HIGHER_IS_BETTER.items()
        ]
        part = m.select(F.inline(F.array(*cells)))
        out = part if out is None else out.unionByName(part)
    return out


MEASURED = """m AS (SELECT sqrt(avg(pow(y - p, 2))) AS lr_rmse, avg(abs(y - p)) AS lr_mae, 1 - avg(pow(y - p, 2)) / var_pop(y) AS lr_r2,
  sqrt(avg(pow(y - 40000, 2))) AS rf_rmse, avg(abs(y - 40000)) AS rf_mae, 1 - avg(pow(y - 40000, 2)) / var_pop(y) AS rf_r2
  FROM (SELECT l_extendedprice AS y, l_quantity * 1500 + 100 AS p FROM lineitem))"""


@query(
    "l17_winner_per_metric",
    f"""WITH {MEASURED} SELECT 'rmse' AS metric, CASE WHEN rf_rmse < lr_rmse THEN 'RandomForestRegressor' ELSE 'LinearRegression' END AS winner FROM m
        UNION ALL SELECT 'mae', CASE WHEN rf_mae < lr_mae THEN 'RandomForestRegressor' ELSE 'LinearRegression' END FROM m
        UNION ALL SELECT 'r2', CASE WHEN rf_r2 > lr_r2 THEN 'RandomForestRegressor' ELSE 'LinearRegression' END FROM m""",
)
def l17(spark, sf):
    return comparison.winners(measured_models(spark, sf))


@query(
    "l18_batch_transform",
    f"""WITH m AS (SELECT regr_slope({PRICE}, l_quantity) AS a, regr_intercept({PRICE}, l_quantity) AS b FROM lineitem)
        SELECT l_orderkey, l_linenumber, round(a * l_quantity + b, 3) AS prediction FROM lineitem, m""",
)
def l18(spark, sf):
    path = scratch_dir(spark, "l18")
    pipelines.save_model(_one_feature_model(spark, sf), path)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rounded(predict.predict_table(lines, path, ["l_orderkey", "l_linenumber"]), "prediction", digits=3)


@query(
    "l19_radar",
    f"""WITH {MEASURED} SELECT 'LinearRegression' AS model, 'rmse' AS axis, round(1 - lr_rmse / greatest(lr_rmse, rf_rmse), 6) AS value FROM m
        UNION ALL SELECT 'RandomForestRegressor', 'rmse', round(1 - rf_rmse / greatest(lr_rmse, rf_rmse), 6) FROM m
        UNION ALL SELECT 'LinearRegression', 'mae', round(1 - lr_mae / greatest(lr_mae, rf_mae), 6) FROM m
        UNION ALL SELECT 'RandomForestRegressor', 'mae', round(1 - rf_mae / greatest(lr_mae, rf_mae), 6) FROM m
        UNION ALL SELECT 'LinearRegression', 'r2', round(lr_r2, 6) FROM m UNION ALL SELECT 'RandomForestRegressor', 'r2', round(rf_r2, 6) FROM m""",
)
def l19(spark, sf):
    return rounded(comparison.radar(measured_models(spark, sf)), "value")


@query("k5_s16_model_roundtrip", f"WITH {WEEKLY} SELECT count(*) AS n, 0 AS mismatches FROM weekly WHERE {COMPLETE}")
def k5(spark, sf):
    rows = weekly(spark, sf).select("reading_id", *CHANNELS)
    model = pipelines.pipeline(CHANNELS[:4], pipelines.least_squares("error")).fit(filters.drop_incomplete_rows(rows, CHANNELS))
    path = scratch_dir(spark, "k5")
    pipelines.save_model(model, path)
    scored = model.transform(filters.drop_incomplete_rows(rows, CHANNELS)).drop("raw_features", "features")
    again = pipelines.load_model(path).transform(scored.withColumnRenamed("prediction", "before"))
    same = F.abs(F.col("prediction") - F.col("before")) < 1e-9
    return again.agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).cast("int").alias("mismatches"))


def label_centres(spark, sf):
    """Mean vector per label: one short row per class, used as fixed centres."""
    cells = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    rows = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c")).orderBy("label").collect()
    return [[cell["m"] for cell in row["c"]] for row in rows]


NEAREST = f"""cells AS ({VECTOR_CELLS}), centres AS (SELECT label AS cluster, i, avg(x) AS m FROM cells GROUP BY label, i),
  d AS (SELECT vec_id, cluster, sum(pow(x - m, 2)) AS d2 FROM cells JOIN centres USING (i) GROUP BY vec_id, cluster),
  best AS (SELECT vec_id, CAST(arg_min(cluster, d2) AS INTEGER) AS cluster, min(d2) AS d2 FROM d GROUP BY vec_id)"""


@query("l21_nearest_centre", f"WITH {NEAREST} SELECT vec_id, cluster, round(d2, 6) AS distance2 FROM best")
def l21(spark, sf):
    nearest = nearest_centre(F.col("embedding"), label_centres(spark, sf))
    found = table(spark, sf, "embeddings").select("vec_id", nearest.alias("found")).select("vec_id", "found.*")
    return rounded(found, "distance2")


@query("a15_inertia", f"WITH {NEAREST} SELECT round(sum(d2), 5) AS inertia FROM best")
def a15(spark, sf):
    return rounded(stats.inertia(table(spark, sf, "embeddings"), "embedding", label_centres(spark, sf)), "inertia", digits=5)


@query(
    "h6_pollution_state",
    f"""WITH {NEAREST} SELECT vec_id, CAST((cluster + 1) % 6 AS INTEGER) AS id,
        CASE (cluster + 1) % 6 WHEN 0 THEN 'Clean' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High' WHEN 3 THEN 'Severe' ELSE 'Cluster ' || (cluster + 1) % 6 END AS label,
        CASE (cluster + 1) % 6 WHEN 0 THEN '🌿' WHEN 1 THEN '🔵' WHEN 2 THEN '🟠' WHEN 3 THEN '🔴' ELSE '🔘' END AS emoji FROM best""",
)
def h6(spark, sf):
    nearest = nearest_centre(F.col("embedding"), label_centres(spark, sf))
    ranks = {c: (c + 1) % 6 for c in range(10)}
    state = scoring.cluster_state(lookup(nearest.getField("cluster"), ranks, nearest.getField("cluster")))
    return table(spark, sf, "embeddings").select("vec_id", state.alias("state")).select("vec_id", "state.*")


@query(
    "h3_co_class_by_model",
    f"SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'HIGH CO Risk' ELSE 'LOW CO Risk' END AS label, user_id % 3 = 0 AS high FROM events WHERE {_hash_sql('event_id', 100)} >= 80",
)
def h3(spark, sf):
    """A third of the users lies above the median, and every feature tells them apart."""
    high = (F.col("user_id") % 3 == 0).cast("int")
    labelled, _ = binarise_by_median(_grouped_events(spark, sf, high).withColumn("co", high.cast("double") * 10), "co", "high")
    train, test = split.hash_split(labelled, "event_id")
    model = pipelines.pipeline(GROUP_FEATURES, pipelines.forest_classifier("high")).fit(train)
    state = scoring.co_state(F.col("prediction")).alias("co_class")
    return model.transform(test).select("event_id", state).select("event_id", "co_class.*")
