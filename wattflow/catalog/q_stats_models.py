"""Catalog: metrics, paired tests and MLlib model building (M*)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..contract import BOOSTED_SEARCH, CATEGORY_INPUTS, NUMERIC_INPUTS
from ..functions import calendar as cal
from ..functions import scalar as sc
from ..functions.normal import two_sided_p_sql
from ..ml import pipelines as ML
from ..ml.imputer import ExactMedianImputer, ExactMedianModel
from ..operators import clean as P
from ..operators import stats as ST
from ..operators import topk as T
from ..plans import metrics as MT
from ..plans.features import model_base
from ..runtime import hand_off, scratch_dir
from ..sources import tables as R
from . import frames as X
from .frames import DR, dr, sql
from .registry import query

SIX = ["air_temperature", "cloud_coverage", "dew_temperature", "sea_level_pressure", "wind_direction", "wind_speed"]

# SQL twin of the two error measures per pair
_ERR_SQL = (
    "SELECT *, abs(label - pred_a) / (label + 1e-9) AS ape_a, abs(label - pred_b) / (label + 1e-9) AS ape_b, "
    "pow(ln(1 + greatest(pred_a, 0)) - ln(1 + greatest(label, 0)), 2) AS sle_a, "
    "pow(ln(1 + greatest(pred_b, 0)) - ln(1 + greatest(label, 0)), 2) AS sle_b FROM pairs"
)


def _errors(spark, d):
    p = X.pairs(spark, d)
    return p.select(
        "*",
        sc.abs_pct_error("label", "pred_a").alias("ape_a"),
        sc.abs_pct_error("label", "pred_b").alias("ape_b"),
        sc.squared_log_error("label", "pred_a").alias("sle_a"),
        sc.squared_log_error("label", "pred_b").alias("sle_b"),
    )


def _base(spark, d):
    return model_base(X.feature(spark, d), R.buildings(spark, d))


def _stored_base(spark, d):
    """The training frame, written once: imputer, indexer and each tree round read it again."""
    return hand_off(_base(spark, d), "model-base")


# ------------------------------------------------------------------ imputation, encoding
@query("m1_mean_imputer", sql(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {DR(f'avg({c})')} AS mean FROM wclean" for c in SIX), "wclean"))
def m1(spark, d):
    _, surrogate = ML.mean_imputer(X.wclean(spark, d), SIX)
    return surrogate.select("column", dr("mean"))


_BASE_SQL = (
    "SELECT f.air_temperature, f.dew_temperature, f.sea_level_pressure, f.wind_speed, ln(1 + CAST(b.square_feet AS DOUBLE)) AS log_sqft, "
    "CAST(b.floor_count AS DOUBLE) AS floor_count, CAST(b.year_built AS DOUBLE) AS year_built, CAST(hour(f.ts) AS DOUBLE) AS hour, "
    "CAST(dayofweek(f.ts) + 1 AS DOUBLE) AS day_of_week, CAST(month(f.ts) AS DOUBLE) AS month, b.primary_use, f.season_flag, f.building_id, f.ts "
    "FROM feature f LEFT JOIN buildings b ON f.building_id = b.building_id"
)


@query(
    "m2_median_imputer",
    sql(
        " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {DR(f'median({c})', 9)} AS median, count(*) - count({c}) AS gaps, 0 AS gaps_left FROM base" for c in NUMERIC_INPUTS),
        "feature", "buildings",
        extra={"base": _BASE_SQL},
    ),
)
def m2(spark, d):
    """The medians of the fitted, saved and loaded imputer, and the gaps of each input before and after it."""
    base = _stored_base(spark, d)
    cols = list(NUMERIC_INPUTS)
    path = scratch_dir(spark, "m2-imputer")
    ExactMedianImputer(inputCols=cols, outputCols=[f"{c}_filled" for c in cols]).fit(base).write().overwrite().save(path)
    model = ExactMedianModel.load(path)
    gaps = [F.struct(F.lit(c).alias("column"), F.lit(m).alias("median"), F.count_if(F.col(c).isNull()).alias("gaps"), F.count_if(F.col(f"{c}_filled").isNull()).cast("int").alias("gaps_left")) for c, m in model.surrogates().items()]
    each = model.transform(base).agg(F.array(*gaps).alias("g")).select(F.explode("g").alias("g")).select("g.*")
    return each.select("column", dr("median", 9), "gaps", "gaps_left")


@query(
    "m3_string_indexer",
    sql(
        "SELECT \"column\", value, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY cnt DESC, value) - 1 AS DOUBLE) AS index FROM ("
        "SELECT 'primary_use' AS \"column\", primary_use AS value, count(*) AS cnt FROM base WHERE primary_use IS NOT NULL GROUP BY ALL UNION ALL "
        "SELECT 'season_flag', season_flag, count(*) FROM base WHERE season_flag IS NOT NULL GROUP BY ALL)",
        "feature", "buildings",
        extra={"base": "SELECT f.season_flag, b.primary_use FROM feature f LEFT JOIN buildings b ON f.building_id = b.building_id"},
    ),
)
def m3(spark, d):
    from pyspark.ml.feature import StringIndexer

    base = _base(spark, d)
    parts = []
    for c in CATEGORY_INPUTS:
        model = StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep").fit(base)
        vocab = [(c, v, float(i)) for i, v in enumerate(model.labels)]  # fitted vocabulary: bounded by the category count
        parts.append(spark.createDataFrame(vocab, "column string, value string, index double"))
    return T.union_all_by_name(parts)


# numeric inputs and a slot for each category value plus one for unseen values
_WIDTH_SQL = f"(SELECT {len(NUMERIC_INPUTS)} + count(DISTINCT primary_use) + 1 + count(DISTINCT season_flag) + 1 FROM base)"
# a category value fills one slot, a missing one the spare slot; zero inputs (hour, ...) are not counted
_NONZERO_SQL = " + ".join(f"(coalesce({c}, (SELECT median({c}) FROM base)) <> 0)::INT" for c in NUMERIC_INPUTS)


@query(
    "m4_one_hot",
    sql(
        "SELECT 'primary_use' AS \"column\", primary_use AS value, count(DISTINCT primary_use) OVER () + 1 AS width, 1.0::DOUBLE AS filled FROM (SELECT DISTINCT primary_use FROM base) "
        "UNION ALL SELECT 'season_flag', season_flag, count(DISTINCT season_flag) OVER () + 1, 1.0::DOUBLE FROM (SELECT DISTINCT season_flag FROM base)",
        "feature", "buildings",
        extra={"base": _BASE_SQL},
    ),
)
def m4(spark, d):
    """M4: the one-hot layout: a slot for each category value and one for unseen values, one slot filled."""
    from pyspark.ml.functions import vector_to_array

    base = _stored_base(spark, d)
    out = Pipeline(stages=ML.encoding().getStages()[1:3]).fit(base).transform(base)
    parts = []
    for c, v in zip(CATEGORY_INPUTS, ML.ENCODED_CATEGORY, strict=True):
        slots = vector_to_array(v)
        total = F.aggregate(slots, F.lit(0.0), lambda a, x: a + x)
        parts.append(out.select(F.lit(c).alias("column"), F.col(c).alias("value"), F.size(slots).cast("bigint").alias("width"), total.alias("filled")).distinct())
    return T.union_all_by_name(parts)


@query(
    "m5_feature_vectors",
    sql(f"SELECT building_id, ts, CAST({_WIDTH_SQL} AS INTEGER) AS n_features, CAST({_NONZERO_SQL} + 2 AS INTEGER) AS n_nonzero FROM base", "feature", "buildings", extra={"base": _BASE_SQL}),
)
def m5(spark, d):
    from pyspark.ml.functions import vector_to_array

    base = _stored_base(spark, d)
    out = ML.encoding().fit(base).transform(base)
    arr = vector_to_array("features")
    return out.select("building_id", "ts", F.size(arr).alias("n_features"), F.size(F.filter(arr, lambda x: x != 0)).alias("n_nonzero"))


@query(
    "m8_named_pipelines",
    sql(
        "SELECT model, stages, n_scored, FALSE AS raises FROM (VALUES ('gbt', 'ImputerModel,StringIndexerModel,OneHotEncoderModel,VectorAssembler,GBTRegressionModel'), "
        "('rf', 'ImputerModel,StringIndexerModel,OneHotEncoderModel,VectorAssembler,RandomForestRegressionModel')) t(model, stages), (SELECT count(*) AS n_scored FROM base) "
        "UNION ALL SELECT 'other', NULL, NULL, TRUE",
        "feature", "buildings",
        extra={"base": _BASE_SQL},
    ),
)
def m8(spark, d):
    """M8: each named pipeline, fitted with a small learner, scores every row; an unknown name raises."""
    base = _stored_base(spark, d)
    rows = []
    for name, changes in (("gbt", {"maxIter": 2}), ("rf", {"numTrees": 2}), ("other", {})):
        try:
            model = ML.fit_pipeline(ML.pipeline_for(name, **changes), base)
        except ValueError:
            rows.append((name, None, None, True))
            continue
        scored = model.transform(base).where("prediction is not null").count()
        rows.append((name, ",".join(type(s).__name__ for s in model.stages), scored, False))
    return spark.createDataFrame(rows, "model string, stages string, n_scored bigint, raises boolean")


_GRID = " CROSS JOIN ".join(
    f"(SELECT CAST(unnest({list(v)}) AS {'INTEGER' if isinstance(v[0], int) else 'DOUBLE'}) AS \"{k}\")" for k, v in BOOSTED_SEARCH.items()
)


@query("m11_candidate_reports")
def m11(spark, d):
    """The measures of each candidate on the test split, and on the rows it was fitted on."""
    train, test = P.hash_split(_stored_base(spark, d), ["building_id", "ts"], (0.8, 0.2))
    rows = []
    for name in ("rf", "gbt"):
        model, _, report = ML.fit_and_score(ML.pipeline_for(name), train, test)
        parts = (("test", report), ("train", MT.regression_report_frame(model.transform(train))))
        rows += [r.select(F.lit(name).alias("model"), F.lit(part).alias("part"), "rmsle", "rmse", "mae", "r2", "n_used") for part, r in parts]
    return T.union_all_by_name(rows)


def _fit_report(spark, d, name):
    """Rows scored in the test split, whether the report has its measures, and whether the fit explains
    the rows it was fitted on better than their mean does."""
    train, test = P.hash_split(_stored_base(spark, d), ["building_id", "ts"], (0.8, 0.2))
    model, _, report = ML.fit_and_score(ML.pipeline_for(name), train, test)
    fitted = MT.regression_report_frame(model.transform(train)).select((F.col("r2") > 0).alias("v")).scalar()
    has = F.col("rmsle").isNotNull() & F.col("rmse").isNotNull() & F.col("mae").isNotNull() & F.col("r2").isNotNull()
    return report.select(F.lit(name).alias("model"), "n_used", fitted.alias("beats_mean"), has.alias("has_measures"))


_TEST_ROWS = "(SELECT count(*) FROM base WHERE " + P.split_sql(["building_id", "ts"], 0.8, 1.0) + ")"


def _fit_sql(name):
    return sql(f"SELECT '{name}' AS model, {_TEST_ROWS} AS n_used, TRUE AS beats_mean, TRUE AS has_measures", "feature", "buildings", extra={"base": _BASE_SQL})


@query("m6_random_forest", _fit_sql("rf"))
def m6(spark, d):
    return _fit_report(spark, d, "rf")


@query("m7_gbt", _fit_sql("gbt"))
def m7(spark, d):
    return _fit_report(spark, d, "gbt")


_DONE: dict = {}  # (application, tables) -> the search and the confirmation, done once for the three queries that report them


def _searched(spark, d):
    """The training rows, the searched points, their validation RMSLE, and the best point's model on those rows."""
    key = (spark.sparkContext.applicationId, d, "search")
    if key not in _DONE:
        train, _ = P.hash_split(_stored_base(spark, d), ["building_id", "ts"], (0.8, 0.2))
        points = ML.search_points("gbt", maxIter=40)
        best, metrics = ML.tune("gbt", points, train)
        _DONE[key] = train, points, metrics, best
    return _DONE[key]


def _confirmed(spark, d):
    """The best point's refitted model and its cross-validated mean RMSLE."""
    key = (spark.sparkContext.applicationId, d, "confirm")
    if key not in _DONE:
        train, points, metrics, best = _searched(spark, d)
        _DONE[key] = ML.confirm_best("gbt", points, metrics, train, fitted=best)
    return _DONE[key]


@query("m10_tuning", f"SELECT *, 40 AS \"maxIter\", TRUE AS has_rmsle FROM {_GRID}")
def m10(spark, d):
    """M9 + M10: every searched point gets a validation RMSLE."""
    _, points, metrics, _ = _searched(spark, d)
    rows = [(int(p["maxDepth"]), int(p["maxBins"]), float(p["stepSize"]), float(p["subsamplingRate"]), int(p["maxIter"]), m > 0) for p, m in zip(points, metrics, strict=True)]
    return spark.createDataFrame(rows, "maxDepth int, maxBins int, stepSize double, subsamplingRate double, maxIter int, has_rmsle boolean")


@query("m10_confirm", "SELECT 3 AS folds, TRUE AS in_grid, TRUE AS has_rmsle, 'GBTRegressionModel' AS last_stage")
def m10c(spark, d):
    """M10 confirm step: the best point of the searched grid, cross-validated and refitted."""
    _, points, metrics, _ = _searched(spark, d)
    model, mean = _confirmed(spark, d)
    last = model.stages[-1]
    used = {"maxDepth": last.getMaxDepth(), "maxBins": last.getMaxBins(), "stepSize": last.getStepSize(), "subsamplingRate": last.getSubsamplingRate(), "maxIter": last.getMaxIter()}
    best = points[min(range(len(metrics)), key=metrics.__getitem__)]
    return spark.createDataFrame([(3, used == best, mean > 0, type(last).__name__)], "folds int, in_grid boolean, has_rmsle boolean, last_stage string")


@query("m10_search_report")
def m10r(spark, d):
    """Each searched point with its validation RMSLE, and the mean RMSLE of the best one's confirmation."""
    _, points, metrics, _ = _searched(spark, d)
    _, mean = _confirmed(spark, d)
    best = min(range(len(metrics)), key=metrics.__getitem__)
    rows = [(p["maxDepth"], p["maxBins"], p["stepSize"], p["subsamplingRate"], p["maxIter"], m, i == best, mean if i == best else None) for i, (p, m) in enumerate(zip(points, metrics, strict=True))]
    return spark.createDataFrame(rows, "maxDepth int, maxBins int, stepSize double, subsamplingRate double, maxIter int, rmsle double, best boolean, confirmed_rmsle double")


# ------------------------------------------------------------------ metrics on the two candidate predictions
@query(
    "m12_model_choice",
    sql(
        "SELECT model, rmsle, rmse, model = (SELECT model FROM t ORDER BY rmsle, rmse, model LIMIT 1) AS chosen FROM t",
        "pairs",
        extra={
            "e": _ERR_SQL,
            "t": "SELECT 'a' AS model, " + DR("sqrt(avg(sle_a))", 9) + " AS rmsle, " + DR("sqrt(avg(pow(pred_a - label, 2)))", 6) + " AS rmse FROM e UNION ALL "
            "SELECT 'b', " + DR("sqrt(avg(sle_b))", 9) + ", " + DR("sqrt(avg(pow(pred_b - label, 2)))", 6) + " FROM e",
        },
    ),
)
def m12(spark, d):
    p = X.pairs(spark, d)
    parts = []
    for name, col in (("a", "pred_a"), ("b", "pred_b")):
        r = MT.regression_report_frame(p, "label", col).select(F.lit(name).alias("model"), dr("rmsle", 9), dr("rmse", 6))
        parts.append(r)
    return MT.choose_model(parts[0].unionByName(parts[1]))


@query(
    "m13_rmsle",
    sql(f"SELECT {DR('sqrt(avg(sle_a))', 9)} AS rmsle, count(*) AS n_used, CAST(0 AS BIGINT) AS n_dropped FROM ({_ERR_SQL})", "pairs"),
    headline=True,
)
def m13(spark, d):
    return MT.rmsle_frame(X.pairs(spark, d), "label", "pred_a").select(dr("rmsle", 9), "n_used", "n_dropped")


@query(
    "m15_regression_report",
    sql(
        f"SELECT {DR('sqrt(avg(sle_b))', 9)} AS rmsle, {DR('sqrt(avg(pow(pred_b - label, 2)))')} AS rmse, {DR('avg(abs(pred_b - label))')} AS mae, "
        f"{DR('1 - avg(pow(pred_b - label, 2)) / var_pop(label)', 9)} AS r2, count(*) AS n_used FROM ({_ERR_SQL})",
        "pairs",
    ),
)
def m15(spark, d):
    r = MT.regression_report_frame(X.pairs(spark, d), "label", "pred_b")
    return r.select(dr("rmsle", 9), dr("rmse"), dr("mae"), dr("r2", 9), "n_used")


@query("m14_rmsle_evaluator", sql(f"SELECT {DR('sqrt(avg(sle_b))', 9)} AS rmsle, false AS larger_is_better FROM ({_ERR_SQL})", "pairs"))
def m14(spark, d):
    ev = MT.rmsle_evaluator()
    value = ev.evaluate(MT.log_view("label", "pred_b").transform(X.pairs(spark, d)))  # one aggregate job; the metric is a scalar
    one = spark.createDataFrame([(float(value), bool(ev.isLargerBetter()))], "rmsle double, larger_is_better boolean")
    return one.select(dr("rmsle", 9), "larger_is_better")


@query("m16_rmse", sql(f"SELECT {DR('sqrt(avg(pow(pred_a - label, 2)))')} AS rmse FROM pairs", "pairs"))
def m16(spark, d):
    return MT.rmse_frame(X.pairs(spark, d), "label", "pred_a").select(dr("rmse"))


def _wilcoxon_sql(a: str, b: str, metric: str) -> str:
    return (
        f"SELECT '{metric}' AS metric, n, n_zero, w_plus, w_minus, least(w_plus, w_minus) AS statistic, mean, "
        f"{DR('se', 6)} AS se, {DR('(least(w_plus, w_minus) - mean) / se', 9)} AS z FROM ("
        "SELECT CAST(sum(t) AS BIGINT) AS n, CAST(coalesce(sum(t) FILTER (WHERE ad = 0), 0) AS BIGINT) AS n_zero, coalesce(sum(np * rk), 0) AS w_plus, "
        "coalesce(sum(nn * rk), 0) AS w_minus, "
        "CAST(sum(t) AS DOUBLE) * (sum(t) + 1) * 0.25 - CAST(coalesce(sum(t) FILTER (WHERE ad = 0), 0) AS DOUBLE) * (coalesce(sum(t) FILTER (WHERE ad = 0), 0) + 1) * 0.25 AS mean, "
        "sqrt((CAST(sum(t) AS DOUBLE) * (sum(t) + 1) * (2 * sum(t) + 1) - CAST(coalesce(sum(t) FILTER (WHERE ad = 0), 0) AS DOUBLE) * (coalesce(sum(t) FILTER (WHERE ad = 0), 0) + 1) "
        "* (2 * coalesce(sum(t) FILTER (WHERE ad = 0), 0) + 1) - 0.5 * coalesce(sum(CAST(t AS DOUBLE) * (CAST(t AS DOUBLE) * t - 1)) FILTER (WHERE ad > 0), 0)) / 24) AS se "
        "FROM (SELECT *, coalesce(sum(t) OVER (ORDER BY ad ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS rk FROM ("
        f"SELECT abs(d) AS ad, count(*) AS t, count(*) FILTER (WHERE d > 0) AS np, count(*) FILTER (WHERE d < 0) AS nn FROM "
        f"(SELECT {a} - {b} AS d FROM ({_ERR_SQL}) WHERE {a} - {b} IS NOT NULL AND NOT isnan({a} - {b})) GROUP BY 1)))"
    )


_M17_SQL = sql(_wilcoxon_sql("ape_a", "ape_b", "ape") + " UNION ALL " + _wilcoxon_sql("sle_a", "sle_b", "sle"), "pairs")


def _m17(spark, d):
    return ST.signed_rank_tests(_errors(spark, d), {"ape": ("ape_a", "ape_b"), "sle": ("sle_a", "sle_b")})


@query("m17_wilcoxon", _M17_SQL, headline=True)
def m17(spark, d):
    return _m17(spark, d).select(
        "metric", "n", "n_zero", "w_plus", "w_minus", "statistic", "mean", dr("se", 6), dr("z", 9)
    )


@query("m17_wilcoxon_p_value", f"SELECT metric, z, {DR(two_sided_p_sql('z'), 15)} AS p_value FROM ({_M17_SQL})")
def m17p(spark, d):
    return ST.p_values(_m17(spark, d).select("metric", dr("z", 9))).select("metric", "z", dr("p_value", 15))


@query(
    "m18_median_difference",
    sql(
        f"SELECT {DR('quantile_cont(ape_a - ape_b, 0.5)', 9)} AS ape_median_diff, {DR('quantile_cont(sle_a - sle_b, 0.5)', 9)} AS sle_median_diff FROM ({_ERR_SQL})",
        "pairs",
    ),
)
def m18(spark, d):
    e = hand_off(_errors(spark, d).select("ape_a", "ape_b", "sle_a", "sle_b"), "m18-errors")
    a = ST.median_difference(e, "ape_a", "ape_b").select(dr("median_diff", 9, "ape_median_diff"))
    b = ST.median_difference(e, "sle_a", "sle_b").select(dr("median_diff", 9, "sle_median_diff"))
    return a.select("ape_median_diff", b.scalar().alias("sle_median_diff"))


_M19_SQL = "SELECT metric, z, abs(z) > 1.959963984540054 AS significant FROM (" + _M17_SQL + ")"


@query("m19_verdict", _M19_SQL)
def m19(spark, d):
    return ST.paired_verdict(m17(spark, d)).select("metric", "z", "significant")


@query("m19_combined_verdict", f"SELECT bool_or(significant) AS models_differ, count(*) AS tests FROM ({_M19_SQL})")
def m19c(spark, d):
    """The models differ if either test is significant."""
    return ST.combined_verdict(ST.paired_verdict(m17(spark, d)))


_M20_INPUTS = ",".join([*(f"{c}_filled" for c in NUMERIC_INPUTS), *(f"{c}_onehot" for c in CATEGORY_INPUTS)])


@query(
    "m20_contract_check",
    sql(
        "SELECT 'stage_order' AS \"check\", 'ImputerModel,StringIndexerModel,OneHotEncoderModel,VectorAssembler' AS item, TRUE AS ok UNION ALL "
        f"SELECT 'assembler_inputs', '{_M20_INPUTS}', TRUE UNION ALL "
        "SELECT DISTINCT 'unseen:season_flag', CASE WHEN month(ts) IN (12, 1, 2) THEN 'Summer' WHEN month(ts) <= 5 THEN 'Autumn' WHEN month(ts) <= 8 THEN 'Winter' ELSE 'Spring' END, FALSE FROM base",
        "feature", "buildings",
        extra={"base": _BASE_SQL},
    ),
)
def m20(spark, d):
    base = _stored_base(spark, d)
    fitted = ML.encoding().fit(base)
    # an incoming frame that carries calendar season names instead of peak/off-peak
    incoming = base.withColumn("season_flag", cal.calendar_season(F.month("ts")))
    return ML.contract_check(fitted, incoming)


@query("m21_parity_rows", sql("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, round(pred_a, 6) AS pred_a, round(pred_b, 6) AS pred_b FROM pairs", "pairs"))
def m21(spark, d):
    """Label against both predictions, every row (a plot would draw a sample of it)."""
    return X.pairs(spark, d).select(*X.PAIR_KEY, "label", F.round("pred_a", 6).alias("pred_a"), F.round("pred_b", 6).alias("pred_b"))


@query(
    "m22_feature_frame",
    sql(
        "SELECT building_id, site_id, ts, interval, round(agg_value, 6) AS agg_value, season_flag, air_temperature, dew_temperature, "
        "sea_level_pressure, wind_speed, cloud_coverage, wind_direction FROM feature",
        "feature",
    ),
    headline=True,
)
def m22(spark, d):
    f = X.feature(spark, d)
    return f.select(*[F.round("agg_value", 6).alias("agg_value") if c == "agg_value" else F.col(c) for c in f.columns])


@query(
    "m23_model_base",
    sql(
        "SELECT f.air_temperature, f.dew_temperature, f.sea_level_pressure, f.wind_speed, "
        + DR("ln(1 + CAST(b.square_feet AS DOUBLE))", 9) + " AS log_sqft, CAST(b.floor_count AS DOUBLE) AS floor_count, "
        "CAST(b.year_built AS DOUBLE) AS year_built, CAST(hour(f.ts) AS DOUBLE) AS hour, CAST(dayofweek(f.ts) + 1 AS DOUBLE) AS day_of_week, "
        "CAST(month(f.ts) AS DOUBLE) AS month, b.primary_use, f.season_flag, round(CAST(f.agg_value AS DOUBLE), 6) AS label, "
        "f.building_id, f.site_id, f.ts FROM feature f LEFT JOIN buildings b ON f.building_id = b.building_id",
        "feature", "buildings",
    ),
)
def m23(spark, d):
    b = _base(spark, d)
    return b.select(*[dr("log_sqft", 9) if c == "log_sqft" else F.round("label", 6).alias("label") if c == "label" else F.col(c) for c in b.columns])


_BOX_COLS = ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi"]


@query(
    "a19_box_stats_ape",
    sql(
        "SELECT model, " + ", ".join(f"{DR(c, 9)} AS {c}" for c in _BOX_COLS) + ", n FROM ("
        "SELECT q.*, min(v) FILTER (WHERE v >= lo_fence) AS whisker_lo, max(v) FILTER (WHERE v <= hi_fence) AS whisker_hi, count(*) AS n "
        "FROM (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM ("
        "SELECT model, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM x GROUP BY 1)) q "
        "JOIN x USING (model) GROUP BY ALL)",
        "pairs",
        extra={
            "e": _ERR_SQL,
            "x": "SELECT 'a' AS model, ape_a AS v FROM e WHERE ape_a IS NOT NULL UNION ALL SELECT 'b', ape_b FROM e WHERE ape_b IS NOT NULL",
        },
    ),
)
def a19ape(spark, d):
    """A19 for the model comparison: APE distribution per candidate (quartiles, fences, whiskers)."""
    e = _errors(spark, d)
    long = e.select(
        F.explode(F.array(F.struct(F.lit("a").alias("model"), F.col("ape_a").alias("v")), F.struct(F.lit("b").alias("model"), F.col("ape_b").alias("v")))).alias("x")
    ).select("x.*")
    b = ST.box_stats(hand_off(long, "a19-values"), "v", ["model"])
    return b.select("model", *[dr(c, 9) for c in _BOX_COLS], "n")


_SLE_LONG = "SELECT 'a' AS model, sle_a AS v FROM e WHERE NOT isnan(sle_a) UNION ALL SELECT 'b', sle_b FROM e WHERE NOT isnan(sle_b)"


def _sle_long(spark, d):
    e = _errors(spark, d)
    return e.select(
        F.explode(F.array(F.struct(F.lit("a").alias("model"), F.col("sle_a").alias("v")), F.struct(F.lit("b").alias("model"), F.col("sle_b").alias("v")))).alias("x")
    ).select("x.*")


@query(
    "a20_sle_histogram",
    sql(
        "SELECT r.model, CAST(s.bin AS INTEGER) AS bin, " + DR("r.lo + s.bin * r.width", 9) + " AS bin_lo, " + DR("r.lo + (s.bin + 1) * r.width", 9)
        + " AS bin_hi, coalesce(b.cnt, 0) AS count, " + DR("coalesce(b.cnt, 0) / (r.n * r.width)", 9) + " AS density "
        "FROM rng r CROSS JOIN range(0, 60) s(bin) LEFT JOIN b ON b.model = r.model AND b.bin = s.bin",
        "pairs",
        extra={
            "e": _ERR_SQL,
            "x": _SLE_LONG,
            "rng": "SELECT model, min(v) AS lo, max(v) AS hi, count(*) AS n, CASE WHEN max(v) > min(v) THEN (max(v) - min(v)) / 60 ELSE 1.0 END AS width FROM x GROUP BY model",
            "b": "SELECT x.model, least(CAST(floor((x.v - rng.lo) / rng.width) AS INTEGER), 59) AS bin, count(*) AS cnt FROM x JOIN rng ON x.model = rng.model GROUP BY 1, 2",
        },
    ),
)
def a20sle(spark, d):
    """A20 as the reference draws it: density histogram (60 bins) of the squared log error per model."""
    h = ST.histogram(_sle_long(spark, d), "v", bins=60, group_cols=["model"])
    return h.select("model", "bin", dr("bin_lo", 9), dr("bin_hi", 9), "count", dr("density", 9))


@query(
    "a21_sle_density",
    sql(
        "SELECT h.model, CAST(g.g AS INTEGER) AS g, " + DR("st2.g_lo + g.g * st2.g_step", 9) + " AS x, "
        + DR("sum(h.cnt * exp(-0.5 * (((st2.g_lo + g.g * st2.g_step) - h.centre) / st2.h) * (((st2.g_lo + g.g * st2.g_step) - h.centre) / st2.h)) / (sqrt(2 * pi()) * st2.n * st2.h))", 9)
        + " AS density FROM hist h JOIN st2 ON h.model = st2.model CROSS JOIN range(0, 100) g(g) GROUP BY 1, 2, 3",
        "pairs",
        extra={
            "e": _ERR_SQL,
            "x": _SLE_LONG,
            "st": "SELECT model, min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) AS sd FROM x GROUP BY model",
            "st1": "SELECT *, CASE WHEN sd * pow(CAST(n AS DOUBLE), -0.2) > 0 THEN sd * pow(CAST(n AS DOUBLE), -0.2) ELSE 1.0 END AS h FROM st",
            "st2": "SELECT model, n, h, lo - 3 * h AS g_lo, (hi - lo + 6 * h) / 99 AS g_step FROM st1",
            "hist": "SELECT model, v AS centre, count(*) AS cnt FROM x GROUP BY 1, 2",
        },
    ),
)
def a21sle(spark, d):
    """A21 as the reference draws it: kernel density of the squared log error per model."""
    k = ST.kernel_density(_sle_long(spark, d), "v", grid=100, group_cols=["model"])
    return k.select("model", "g", dr("x", 9), dr("density", 9))
