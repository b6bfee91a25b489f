"""

Every query reads the given tables whole. Where a query needs scores but does
not train a model, they come from an md5 of the row's key, so that SQL can
repeat them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkexp.config import ColumnRoles, ExperimentPaths
from sparkexp.functions.columns import as_boolean, key_hash, weeks_before
from sparkexp.operators import batches, boosting, features, histogram, metrics, split
from sparkexp.plans.evaluation import Evaluation, evaluate, report_table
from sparkexp.plans.experiment import run_experiment
from sparkexp.plans.scoring import predict, score_table
from sparkexp.plans.together import run_together
from sparkexp.sources.scratch import discard, materialize, scratch_path
from sparkexp.sources.synthetic import with_synthetic_columns
from sparkexp.sources.tables import (
    read_predictions,
    read_table,
    table_shape,
    write_metrics,
    write_predictions,
)

BATCH_SIZE = 1000
# Small enough that the running totals cross many buckets already on the test tables.
SMALL_BUCKETS = 4000
LINEITEM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINEITEM_PREDICTORS = ("l_quantity", "l_discount", "l_tax")
# Predictors with few values, so that SQL can try every split.
STUMP_PREDICTORS = ("l_discount", "l_tax")
STUMP_PARAMS = {"max_depth": 1, "eta": 0.5, "subsample": 1.0, "lambda": 1, "objective": "reg:squarederror", "max_bin": 64}
TREE_PARAMS = {"max_depth": 3, "eta": 0.5, "subsample": 0.8, "lambda": 1, "objective": "reg:squarederror"}


# ---------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").withColumn("target", F.col("o_orderstatus") == "F")


def _score(key: str, target: Column, fine: bool) -> Column:
    """Scores that lean towards the label; the coarse ones are often tied."""
    number, one = F.pmod(key_hash([key], 7), F.lit(1 << 32)), target.cast("long")
    if fine:
        return (number + one * 2147483648).cast("double") / 6442450944.0
    return (F.pmod(number, F.lit(700)) + one * 300).cast("double") / 1000.0


def _scored_orders(spark: SparkSession, sf_dir: str, fine: bool = False) -> DataFrame:
    return _orders(spark, sf_dir).withColumn("final_score", _score("o_orderkey", F.col("target"), fine))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").withColumn("target", F.col("event_type") == "purchase")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").withColumn("target", F.col("l_quantity") * F.col("l_discount") > 1)


def _order_bounds(orders: DataFrame) -> split.SplitBounds:
    return split.resolve_bounds(orders, "o_orderdate")


def _event_bounds(events: DataFrame) -> split.SplitBounds:
    return split.resolve_bounds(events, "ts", val_weeks=1, test_weeks=1)


# ---------------------------------------------------------------- splits


def entry(spark: SparkSession) -> DataFrame:
    """Spans and sizes of the train, validation and test parts of the orders."""
    return q_split_spans(spark, "/root/testdata/sf0.001")


def q_read_table(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/labels.parquet", ["doc_id", "toxic"])


def q_table_shape(spark, sf_dir):
    return table_shape(_table(spark, sf_dir, "lineitem"))


def q_date_bounds(spark, sf_dir):
    return split.date_bounds(_table(spark, sf_dir, "orders"), "o_orderdate")


def q_date_bounds_text(spark, sf_dir):
    text = _table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return split.date_bounds(text, "day")


def q_weeks_before(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    return orders.select("o_orderkey", weeks_before(day, 4).alias("four_weeks"), weeks_before(day, 8).alias("eight_weeks"))


def q_target_cast(spark, sf_dir):
    labels = split.cast_target(_table(spark, sf_dir, "labels"), "toxic")
    return labels.select("doc_id", "toxic", (~F.col("toxic")).alias("not_toxic"))


def q_target_cast_lenient(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", as_boolean(F.col("o_orderstatus"), lenient=True).alias("target"))


def q_label_projection(spark, sf_dir):
    labels = split.cast_target(_table(spark, sf_dir, "labels"), "quality")
    return labels.select("doc_id", F.col("quality").cast("double").alias("label"))


def q_target_counts(spark, sf_dir):
    return metrics.target_counts(_table(spark, sf_dir, "labels"), "toxic")


def q_temporal_split(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return split.temporal_split(orders, "o_orderdate", _order_bounds(orders)).select("o_orderkey", "split")


def q_temporal_split_events(spark, sf_dir):
    events = _events(spark, sf_dir)
    return split.temporal_split(events, "ts", _event_bounds(events)).select("event_id", "split")


def q_split_counts(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return split.split_counts(orders, "o_orderdate", _order_bounds(orders))


def q_split_counts_events(spark, sf_dir):
    events = _events(spark, sf_dir)
    return split.split_counts(events, "ts", _event_bounds(events))


def q_split_counts_capped(spark, sf_dir):
    """An end before the last row, so that the upper bound of the test part matters."""
    orders = _orders(spark, sf_dir)
    bounds = split.bounds_from_dates("1996-01-01", "1998-06-30")
    return split.split_counts(orders, "o_orderdate", bounds, cap_test=True)


def q_split_spans(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return split.split_spans(orders, "o_orderdate", _order_bounds(orders))


def q_split_spans_events(spark, sf_dir):
    events = _events(spark, sf_dir)
    return split.split_spans(events, "ts", _event_bounds(events))


def q_split_filters_lineitem(spark, sf_dir):
    prepared = split.prepare_experiment(
        _lineitem(spark, sf_dir), target_col="target", datetime_col="l_shipdate", experiment_id="lineitem"
    )
    sums = [
        part.agg(F.count(F.lit(1)).alias("row_count"), F.sum("l_orderkey").alias("key_sum")).select(
            F.lit(name).alias("split"), "row_count", "key_sum"
        )
        for name, part in (("train", prepared.train), ("val", prepared.val), ("test", prepared.test))
    ]
    return sums[0].unionByName(sums[1]).unionByName(sums[2])


# ---------------------------------------------------------------- batches


def q_num_batches(spark, sf_dir):
    return batches.num_batches_table(_table(spark, sf_dir, "orders"), BATCH_SIZE)


def q_assign_batches(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    batched = batches.assign_batches(orders, "o_orderkey", BATCH_SIZE, spread=["o_custkey"])
    return batched.select("o_orderkey", "batch_id")


def q_batch_ledger(spark, sf_dir):
    batched = batches.assign_batches(_orders(spark, sf_dir), "o_orderkey", BATCH_SIZE, spread=["o_custkey"])
    return batches.batch_ledger(batched, "target")


def q_batch_ledger_lineitem(spark, sf_dir):
    key = ["l_orderkey", "l_linenumber"]
    batched = batches.assign_batches(_lineitem(spark, sf_dir), key, 100, spread=["l_partkey"])
    return batches.batch_ledger(batched, "target")


def q_deal_batches(spark, sf_dir):
    """Sizes of batches when only seven values tell rows apart: equal rows are dealt one by one."""
    lines = _table(spark, sf_dir, "lineitem").select("l_linenumber")
    dealt, path = batches.deal_batches(lines, "l_linenumber", 40)
    sizes, _ = materialize(dealt.groupBy("batch_id").agg(F.count(F.lit(1)).alias("row_count")), "sizes")
    discard(spark, path)
    return sizes


# ---------------------------------------------------------------- metrics


def q_class_scores_pos(spark, sf_dir):
    return metrics.class_scores(_scored_orders(spark, sf_dir), "target")


def q_class_scores_neg(spark, sf_dir):
    return metrics.class_scores(_scored_orders(spark, sf_dir), "target", positive=False)


def _rounded(df: DataFrame) -> DataFrame:
    names = {"logloss", "auc", "auprc"}
    return df.select(*[F.round(c, 9).alias(c) if c in names else c for c in df.columns])


def q_log_loss(spark, sf_dir):
    return _rounded(metrics.log_loss(_scored_orders(spark, sf_dir), "target"))


def q_roc_auc(spark, sf_dir):
    return _rounded(metrics.roc_auc(_scored_orders(spark, sf_dir), "target"))


def q_average_precision(spark, sf_dir):
    return _rounded(metrics.average_precision(_scored_orders(spark, sf_dir), "target"))


def q_binary_metrics(spark, sf_dir):
    fine = _scored_orders(spark, sf_dir, fine=True)
    return _rounded(metrics.binary_metrics(fine, "target", rows_per_bucket=SMALL_BUCKETS))


def q_binary_metrics_by_split(spark, sf_dir):
    events = _events(spark, sf_dir)
    scored = events.withColumn("final_score", _score("event_id", F.col("target"), fine=True))
    parts = split.temporal_split(scored, "ts", _event_bounds(events))
    return _rounded(metrics.binary_metrics(parts, "target", by=["split"], rows_per_bucket=SMALL_BUCKETS))


def q_binary_metrics_undefined(spark, sf_dir):
    """Priorities with scores above 1, missing scores, or one class: their metrics are null."""
    priority, status = F.col("o_orderpriority"), F.col("target")
    odd = (
        F.when(priority == "1-URGENT", F.col("final_score") + 1)
        .when((priority == "2-HIGH") & (F.pmod("o_orderkey", F.lit(100)) == 0), F.lit(None))
        .otherwise(F.col("final_score"))
    )
    rows = _scored_orders(spark, sf_dir).withColumns(
        {"final_score": odd, "target": F.when(priority == "5-LOW", F.lit(False)).otherwise(status)}
    )
    return _rounded(metrics.binary_metrics(rows, "target", by=["o_orderpriority"]))


def q_roc_curve(spark, sf_dir):
    fine = _scored_orders(spark, sf_dir, fine=True)
    return metrics.roc_curve(fine, "target", drop_intermediate=False, rows_per_bucket=SMALL_BUCKETS)


def q_roc_curve_compact(spark, sf_dir):
    fine = _scored_orders(spark, sf_dir, fine=True)
    return metrics.roc_curve(fine, "target", rows_per_bucket=SMALL_BUCKETS)


def q_score_histogram_pos(spark, sf_dir):
    return histogram.score_histogram(_scored_orders(spark, sf_dir), "target")


def q_score_histogram_neg(spark, sf_dir):
    return histogram.score_histogram(_scored_orders(spark, sf_dir), "target", positive=False)


def q_class_histograms(spark, sf_dir):
    lineitem = _lineitem(spark, sf_dir).withColumn("final_score", F.col("l_extendedprice"))
    return histogram.class_histograms(lineitem, "target")


# ---------------------------------------------------------------- sources and sinks


def q_synthetic_labeled(spark, sf_dir):
    ids = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    made = with_synthetic_columns(ids, ratio=0.01)
    return made


def q_predictions_roundtrip(spark, sf_dir):
    scored = batches.assign_batches(_scored_orders(spark, sf_dir), "o_orderkey", BATCH_SIZE, spread=["o_custkey"])
    root = scratch_path(spark, "predictions")
    path = f"{root}/experiment_id=20230101000000/prefix=test"
    write_predictions(scored.select("o_orderkey", "target", "final_score", "batch_id"), path)
    back = read_predictions(spark, path, base_path=root)
    return back.select("o_orderkey", "target", "final_score", "batch_id", "experiment_id", "prefix")


def q_metrics_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    write_metrics(metrics.binary_metrics(_scored_orders(spark, sf_dir), "target"), path)
    return _rounded(spark.read.parquet(path))


# ---------------------------------------------------------------- learning


def _events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.pmod("event_id", F.lit(7)) != 0, F.col("value"))
    return _events(spark, sf_dir).select("event_id", "target", value.alias("value"))


def q_impute_indicator(spark, sf_dir):
    """The value where there is one; where not, whether the fill is a value whose rank is within one in a thousand of the middle."""
    events = _events_with_gaps(spark, sf_dir)
    filled = features.impute_missing(events, ["value"])
    near = events.agg(F.percentile("value", [0.499, 0.501]).alias("near")).first().near
    fits = F.col("value_filled").between(*near)
    return filled.select(
        "event_id",
        "value_missing",
        F.when(F.col("value_missing") == 0, F.col("value_filled")).alias("kept_value"),
        F.when(F.col("value_missing") == 1, fits).alias("fill_is_median"),
    )


def _model_summary(df: DataFrame, model: boosting.TrainedModel) -> DataFrame:
    """Row counts, missing scores and whether the ranking beats chance, from a stored table of scores."""
    scored = score_table(model, df, target="target", batches=1, keep_columns=[], key=LINEITEM_KEY)
    stored, path = materialize(scored.select("target", "final_score"), "scored")
    auc = metrics.roc_auc(stored, "target").first().auc
    counts = stored.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("final_score").isNull()).alias("null_scores")
    ).first()
    discard(df.sparkSession, path)
    return df.sparkSession.range(1).select(
        F.lit(counts.row_count).cast("long").alias("row_count"),
        F.lit(counts.null_scores).cast("long").alias("null_scores"),
        F.lit(auc > 0.9).alias("beats_chance"),
    )


def _stump_scores(spark: SparkSession, sf_dir: str, rounds: int) -> DataFrame:
    """Scores of trees of depth one, trained on all rows as one batch."""
    lineitem = _lineitem(spark, sf_dir)
    model = boosting.train_gbt_incremental(
        lineitem, predictors=STUMP_PREDICTORS, target="target", params=STUMP_PARAMS, batches=1, rounds=rounds, key=LINEITEM_KEY
    )
    scored = model.score(lineitem)
    return scored.select("l_orderkey", "l_linenumber", F.round("final_score", 9).alias("score"))


def q_stump_scores(spark, sf_dir):
    return _stump_scores(spark, sf_dir, 1)


def q_two_stump_scores(spark, sf_dir):
    return _stump_scores(spark, sf_dir, 2)


def _one_stump(lineitem: DataFrame, predictors: tuple[str, ...], penalty: float) -> DataFrame:
    params = {**STUMP_PARAMS, "lambda": penalty}
    model = boosting.train_gbt(lineitem, predictors=predictors, target="target", params=params, max_iter=1, key=LINEITEM_KEY)
    return model.score(lineitem).select("l_orderkey", "l_linenumber", F.round("final_score", 9).alias("score"))


def q_stump_scores_gaps(spark, sf_dir):
    """Predictors with missing values; every split is tried with them on either side."""
    gappy = _lineitem(spark, sf_dir).withColumns(
        {
            "l_discount": F.when(F.pmod("l_orderkey", F.lit(3)) != 0, F.col("l_discount")),
            "l_tax": F.when(F.pmod("l_partkey", F.lit(4)) != 0, F.col("l_tax")),
        }
    )
    return _one_stump(gappy, STUMP_PREDICTORS, 1)


def q_stump_scores_penalised(spark, sf_dir):
    """A penalty of a tenth of the rows, with which another column is split than without."""
    odd = (F.col("l_linenumber") >= 6) | ((F.col("l_discount") >= 0.08) == (F.col("l_tax") >= 0.06))
    lineitem = _lineitem(spark, sf_dir).withColumn("target", odd)
    return _one_stump(lineitem, ("l_linenumber", "l_tax"), lineitem.count() / 10)


def q_train_predict_summary(spark, sf_dir):
    lineitem = _lineitem(spark, sf_dir)
    model = boosting.train_gbt(
        lineitem,
        predictors=LINEITEM_PREDICTORS,
        target="target",
        key=LINEITEM_KEY,
        params={**TREE_PARAMS, "objective": "binary:logistic"},
        max_iter=5,
    )
    return _model_summary(lineitem, model)


def q_incremental_summary(spark, sf_dir):
    lineitem = _lineitem(spark, sf_dir)
    model = boosting.train_gbt_incremental(
        lineitem,
        predictors=LINEITEM_PREDICTORS,
        target="target",
        params=TREE_PARAMS,
        batch_size=lineitem.count() // 2 + 1,
        rounds=3,
        key=LINEITEM_KEY,
    )
    return _model_summary(lineitem, model)


def q_predict_saved_model(spark, sf_dir):
    """Train with missing values, save, load, score and read back; the target and two columns are forwarded."""
    events = _events_with_gaps(spark, sf_dir)
    paths = ExperimentPaths(scratch_path(spark, "experiment"))
    model = boosting.train_gbt_incremental(
        events, predictors=["value"], target="target", params=TREE_PARAMS, batch_size=events.count(), rounds=2, key=["event_id"]
    )
    model_path = boosting.save_model(model, paths.model("e1"))
    folder = predict(
        experiment_id="e1",
        prefix="val",
        model_path=model_path,
        data=events,
        predictors=["value"],
        target_column="target",
        paths=paths,
        batch_size=BATCH_SIZE,
        keep_columns=["event_id", "value"],
        key=["event_id"],
        spread=(),
    )
    back = read_predictions(spark, folder)
    return back.select(
        "event_id",
        "target",
        "value",
        "batch_id",
        F.col("final_score").isNotNull().alias("has_score"),
    )


# ---------------------------------------------------------------- report and whole run


def _order_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_orders(spark, sf_dir)
    bounds = _order_bounds(scored)

    def evaluate_part(prefix: str) -> Evaluation:
        part = split.split_part(scored, "o_orderdate", bounds, prefix)
        return evaluate(part, target_col="target", output=scratch_path(spark, f"report-{prefix}"))

    prefixes = ("val", "test")
    evaluations = dict(zip(prefixes, run_together(*[partial(evaluate_part, prefix) for prefix in prefixes])))
    return report_table("orders", split.split_spans(scored, "o_orderdate", bounds), evaluations)


def q_report_table(spark, sf_dir):
    report = _order_report(spark, sf_dir)
    return report.select(*[F.round(c, 9).alias(c) if c == "value" else c for c in report.columns])


def q_evaluation_metrics(spark, sf_dir):
    found = evaluate(_scored_orders(spark, sf_dir, fine=True), target_col="target", rows_per_bucket=SMALL_BUCKETS)
    return _rounded(found.metrics)


def _experiment_summary(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    lineitem = _lineitem(spark, sf_dir)
    roles = ColumnRoles("target", "l_shipdate", LINEITEM_PREDICTORS, key=LINEITEM_KEY, keep=("l_orderkey",))
    paths = ExperimentPaths(scratch_path(spark, "experiment"))
    done = run_experiment(
        lineitem,
        roles,
        paths,
        experiment_id="run1",
        **options,
    )
    scored = read_predictions(spark, paths.predictions("run1"))
    aucs = {prefix: found.metrics.first().auc for prefix, found in done.evaluations.items()}
    return (
        scored.groupBy("prefix")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if("target").alias("positives"),
            F.sum("l_orderkey").alias("key_sum"),
            F.count_if(F.col("final_score").isNull()).alias("null_scores"),
        )
        .withColumn("beats_chance", F.lit(all(auc > 0.9 for auc in aucs.values())))
    )


def q_run_experiment_summary(spark, sf_dir):
    return _experiment_summary(spark, sf_dir, params=TREE_PARAMS, batches=2, rounds=2)


def q_run_experiment_one_fit_summary(spark, sf_dir):
    params = {**TREE_PARAMS, "objective": "binary:logistic"}
    return _experiment_summary(spark, sf_dir, params=params, trainer="one_fit", rounds=5)


def _text_queries() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the optional subpackage for training text and of its pipeline, where they are present."""
    try:
        import corpus_pipeline
        from sparkexp.llm import queries as text_queries
    except ModuleNotFoundError as error:
        # Only the absence of these parts is expected; a library they lack is an error.
        if error.name not in ("corpus_pipeline", "sparkexp.llm"):
            raise
        return {}, {}
    found, sql = dict(text_queries.queries()), dict(text_queries.oracle_sql())
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    own = {name[2:]: function for name, function in globals().items() if name.startswith("q_")}
    return {**own, **_text_queries()[0]}


# ---------------------------------------------------------------- the same in SQL


def _hash_sql(columns: str, seed: int) -> str:
    """The number of a row's key: each column's text after its length, then the seed."""
    text = " || ".join(f"length({c}::VARCHAR) || ':' || {c}::VARCHAR" for c in columns.split())
    return f"CAST('0x' || substr(md5({text} || '|{seed}'), 1, 15) AS BIGINT)"


def _scored_sql(fine: bool = False, source: str = "orders") -> str:
    """Table expression with the key, the date, the label ``y`` and the score ``s``."""
    key, day, label = {
        "orders": ("o_orderkey", "o_orderdate", "o_orderstatus = 'F'"),
        "events": ("event_id", "ts", "event_type = 'purchase'"),
    }[source]
    number, one = f"({_hash_sql(key, 7)} % 4294967296)", f"CAST(({label}) AS BIGINT)"
    score = (
        f"CAST({number} + {one} * 2147483648 AS DOUBLE) / CAST(6442450944 AS DOUBLE)"
        if fine
        else f"CAST({number} % 700 + {one} * 300 AS DOUBLE) / CAST(1000 AS DOUBLE)"
    )
    return f"(SELECT *, {day} AS d, ({label}) AS y, {score} AS s FROM {source})"


def _bounds_sql(table: str, day: str, weeks: int) -> str:
    return (
        f"(SELECT first_day, last_day - {14 * weeks} AS val_day, last_day - {7 * weeks} AS test_day, last_day FROM "
        f"(SELECT CAST(min({day}) AS DATE) AS first_day, CAST(max({day}) AS DATE) AS last_day FROM {table}))"
    )


def _split_case(day: str) -> str:
    return (
        f"CASE WHEN {day} >= first_day AND {day} < val_day THEN 'train' "
        f"WHEN {day} >= val_day AND {day} < test_day THEN 'val' WHEN {day} >= test_day THEN 'test' END"
    )


def _spans_sql(table: str, day: str, weeks: int) -> str:
    return f"""
        WITH b AS {_bounds_sql(table, day, weeks)},
        c AS (SELECT {_split_case(day)} AS split, count(*) AS n FROM {table}, b GROUP BY 1)
        SELECT period, CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date,
               coalesce(n, 0) AS row_count, w.split AS split
        FROM (SELECT 'train' AS split, 'Train' AS period, first_day AS start_date, val_day AS end_date FROM b
              UNION ALL SELECT 'val', 'Validation', val_day, test_day FROM b
              UNION ALL SELECT 'test', 'Test', test_day, last_day FROM b) w LEFT JOIN c ON w.split = c.split"""


def _metrics_sql(scored: str, key: str | None = None) -> str:
    """Log loss, AUC and average precision from first principles, by ``key``."""
    k = key or "1"
    eps = "2.220446049250313e-16"
    clip = f"least(greatest(s, {eps}), 1 - {eps})"
    return f"""
        WITH t AS (SELECT {k} AS k, y, s FROM {scored}),
        a AS (SELECT k, count(*) FILTER (WHERE y) AS np, count(*) FILTER (WHERE NOT y) AS nn,
                     count(*) FILTER (WHERE y IS NULL OR s IS NULL) AS bad,
                     count(*) FILTER (WHERE s < 0 OR s > 1) AS outside,
                     -avg(CASE WHEN y THEN ln({clip}) ELSE ln(1 - {clip}) END) AS loss FROM t GROUP BY k),
        g AS (SELECT k, s, count(*) FILTER (WHERE y) AS p, count(*) FILTER (WHERE NOT y) AS n
              FROM t WHERE s IS NOT NULL GROUP BY k, s),
        c AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM g
              WINDOW w AS (PARTITION BY k ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
        r AS (SELECT k, sum(CAST(n AS DOUBLE) * (tp - p / 2.0)) AS area,
                     sum(CAST(p AS DOUBLE) * tp / (tp + fp)) AS steps FROM c GROUP BY k)
        SELECT a.k AS k,
               round(CASE WHEN bad = 0 AND outside = 0 AND np > 0 AND nn > 0 THEN loss END, 9) AS logloss,
               round(CASE WHEN bad = 0 AND np > 0 AND nn > 0 THEN area / (CAST(np AS DOUBLE) * nn) END, 9) AS auc,
               round(CASE WHEN bad = 0 THEN CASE WHEN np = 0 THEN 0 ELSE steps / np END END, 9) AS auprc
        FROM a LEFT JOIN r ON a.k IS NOT DISTINCT FROM r.k"""


def _roc_sql(scored: str, compact: bool) -> str:
    keep = "WHERE tp + fp = p + n OR nxt_p IS NULL OR nxt_p <> p OR nxt_n <> n" if compact else ""
    return f"""
        WITH g AS (SELECT s, count(*) FILTER (WHERE y) AS p, count(*) FILTER (WHERE NOT y) AS n FROM {scored} GROUP BY s),
        c AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS np, sum(n) OVER () AS nn,
                     lead(p) OVER (ORDER BY s DESC) AS nxt_p, lead(n) OVER (ORDER BY s DESC) AS nxt_n
              FROM g WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
        SELECT s AS threshold, CAST(fp AS DOUBLE) / nn AS fpr, CAST(tp AS DOUBLE) / np AS tpr FROM c {keep}
        UNION ALL SELECT CAST('Infinity' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)"""


def _histogram_sql(scored: str) -> str:
    """Both classes, 50 bins each; a value belongs to the bin whose edges enclose it."""
    return f"""
        WITH t AS (SELECT y, CAST(s AS DOUBLE) AS s FROM {scored}),
        e AS (SELECT y, i, lo + i * ((hi - lo) / 50) AS low_edge,
                     CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 50) END AS high_edge
              FROM (SELECT y, min(s) AS lo, max(s) AS hi FROM t GROUP BY y), (SELECT unnest(range(50)) AS i))
        SELECT e.y AS target, CAST(i AS INTEGER) AS bin, low_edge, high_edge, count(t.s) AS row_count
        FROM e LEFT JOIN t ON t.y = e.y AND t.s >= low_edge AND (t.s < high_edge OR (i = 49 AND t.s = high_edge))
        GROUP BY e.y, i, low_edge, high_edge"""


def _ledger_sql(table: str, batch: str, label: str, size: int) -> str:
    return f"""
        WITH k AS (SELECT CAST(ceil(count(*) / {size}.0) AS BIGINT) AS k FROM {table}),
        g AS (SELECT {batch} % k AS batch_id, count(*) AS row_count,
                     count(*) FILTER (WHERE {label}) AS positives, count(*) FILTER (WHERE NOT ({label})) AS negatives
              FROM {table}, k GROUP BY 1)
        SELECT *, CAST(sum(row_count) OVER (ORDER BY batch_id) AS BIGINT) AS running_rows,
               CAST(sum(row_count) OVER (ORDER BY batch_id) AS DOUBLE) / sum(row_count) OVER () * 100 AS percent_done
        FROM g"""


def _report_sql() -> str:
    """The report on the orders, section by section."""
    bounds = _bounds_sql("orders", "o_orderdate", 4)
    parts = [
        f"""SELECT 'Experiment Details' AS section, period AS item, 'size' AS key, CAST(NULL AS DOUBLE) AS x,
            CAST(row_count AS DOUBLE) AS value,
            strftime(start_date, '%Y-%m-%d') || ' to ' || strftime(end_date, '%Y-%m-%d') AS label
            FROM ({_spans_sql('orders', 'o_orderdate', 4)})"""
    ]
    for prefix, title in (("val", "Validation Report"), ("test", "Test Report")):
        rows = f"(SELECT y, s FROM {_scored_sql()} o, {bounds} b WHERE {_split_case('d')} = '{prefix}')"

        def add(item: str, key: str, x: str, value: str, source: str, title: str = title) -> None:
            parts.append(
                f"SELECT '{title}', '{item}', {key}, CAST({x} AS DOUBLE), CAST({value} AS DOUBLE), NULL FROM ({source})"
            )

        for name in ("logloss", "auc", "auprc"):
            add("metrics", f"'{name}'", "NULL", name, _metrics_sql(rows))
        add(
            "target_counts",
            "name",
            "NULL",
            "amount",
            f"SELECT 'True' AS name, count(*) FILTER (WHERE y) AS amount FROM {rows} "
            f"UNION ALL SELECT 'False', count(*) FILTER (WHERE NOT y) FROM {rows}",
        )
        add("roc_curve", "'tpr'", "fpr", "tpr", _roc_sql(rows, compact=True))
        add(
            "score_histogram",
            "CASE WHEN target THEN 'True' ELSE 'False' END",
            "low_edge",
            "row_count",
            _histogram_sql(rows),
        )
    union = "\nUNION ALL ".join(parts)
    return f"SELECT 'orders' AS experiment_id, section, item, key, x, round(value, 9) AS value, label FROM ({union})"


def _stumps_sql(rounds: int) -> str:
    """Trees of depth one: every split is tried, and each side moves by its mean residual with a penalty of 1."""
    parts = [
        """m0 AS (SELECT l_orderkey, l_linenumber, l_discount, l_tax,
            CAST(l_quantity * l_discount > 1 AS INTEGER)::DOUBLE AS y, 0.5::DOUBLE AS s FROM lineitem)"""
    ]
    for i in range(rounds):
        parts.append(f"""
        v{i} AS (SELECT p, x, sum(y - s) AS g, count(*) AS h FROM (
            SELECT 0 AS p, l_discount AS x, y, s FROM m{i} UNION ALL SELECT 1, l_tax, y, s FROM m{i}) GROUP BY p, x),
        c{i} AS (SELECT p, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY p) AS ga,
            sum(h) OVER (PARTITION BY p) AS ha FROM v{i} WINDOW w AS (PARTITION BY p ORDER BY x)),
        b{i} AS (SELECT p, x, 0.5 * gl / (hl + 1) AS low, 0.5 * (ga - gl) / (ha - hl + 1) AS high FROM c{i} WHERE hl < ha
            ORDER BY gl * gl / hl + (ga - gl) * (ga - gl) / (ha - hl) DESC LIMIT 1),
        m{i + 1} AS (SELECT l_orderkey, l_linenumber, l_discount, l_tax, y,
            s + CASE WHEN CASE WHEN p = 0 THEN l_discount ELSE l_tax END <= x THEN low ELSE high END AS s FROM m{i}, b{i})""")
    return f"WITH {', '.join(parts)} SELECT l_orderkey, l_linenumber, round(s, 9) AS score FROM m{rounds}"


def _one_stump_sql(first: str, second: str, label: str, penalty: str) -> str:
    """One split of two columns: each is tried after each value, with the missing values on either side."""
    return f"""
        WITH m AS (SELECT l_orderkey, l_linenumber, CAST({first} AS DOUBLE) AS a, CAST({second} AS DOUBLE) AS b,
                          CAST({label} AS INTEGER)::DOUBLE - 0.5::DOUBLE AS r FROM lineitem),
        u AS (SELECT 0 AS p, a AS x, r FROM m UNION ALL SELECT 1, b, r FROM m),
        n AS (SELECT p, sum(r) AS ga, count(*) AS ha, coalesce(sum(r) FILTER (WHERE x IS NULL), 0) AS gn,
                     count(*) FILTER (WHERE x IS NULL) AS hn, CAST({penalty} AS DOUBLE) AS k FROM u GROUP BY p),
        v AS (SELECT p, x, sum(r) AS g, count(*) AS h FROM u WHERE x IS NOT NULL GROUP BY p, x),
        c AS (SELECT p, x, sum(g) OVER w AS g, sum(h) OVER w AS h FROM v WINDOW w AS (PARTITION BY p ORDER BY x)),
        s AS (SELECT p, x, true AS up, g AS gl, h AS hl, ga, ha, k FROM c JOIN n USING (p)
              UNION ALL SELECT p, x, false, g + gn, h + hn, ga, ha, k FROM c JOIN n USING (p) WHERE hn > 0),
        b AS (SELECT p, x, up, 0.5 * gl / (hl + k) AS low, 0.5 * (ga - gl) / (ha - hl + k) AS high FROM s WHERE hl < ha
              ORDER BY gl * gl / (hl + k) + (ga - gl) * (ga - gl) / (ha - hl + k) DESC LIMIT 1)
        SELECT l_orderkey, l_linenumber,
               round(0.5::DOUBLE + CASE WHEN coalesce(CASE WHEN p = 0 THEN a ELSE m.b END > x, up) THEN high ELSE low END, 9) AS score FROM m, b"""


def oracle_sql() -> dict[str, str]:
    """The SQL for each query, for DuckDB over the same tables."""
    orders, fine = _scored_sql(), _scored_sql(fine=True)
    order_batch = _hash_sql("o_orderkey o_custkey", 42)
    event_batch = _hash_sql("event_id", 42)
    line_batch = _hash_sql("l_orderkey l_linenumber l_partkey", 42)
    line_label = "l_quantity * l_discount > 1"
    by_size = f"CAST(ceil(count(*) / {BATCH_SIZE}.0) AS BIGINT)"
    order_days, event_days = _bounds_sql("orders", "o_orderdate", 4), _bounds_sql("events", "ts", 1)
    line_days = _bounds_sql("lineitem", "l_shipdate", 4)
    learned = "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS null_scores, true AS beats_chance FROM lineitem"
    histograms = _histogram_sql(orders)
    odd = f"""(SELECT o_orderpriority, CASE WHEN o_orderpriority = '5-LOW' THEN false ELSE y END AS y,
        CASE WHEN o_orderpriority = '1-URGENT' THEN s + 1
             WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 100 = 0 THEN NULL ELSE s END AS s FROM {orders})"""
    experiment = f"""SELECT {_split_case('l_shipdate')} AS prefix, count(*) AS row_count,
            count(*) FILTER (WHERE {line_label}) AS positives, CAST(sum(l_orderkey) AS BIGINT) AS key_sum,
            CAST(0 AS BIGINT) AS null_scores, true AS beats_chance
            FROM lineitem, {line_days} b WHERE {_split_case('l_shipdate')} IN ('val', 'test') GROUP BY 1"""
    return {
        "read_table": "SELECT doc_id, toxic FROM labels",
        "table_shape": """SELECT (SELECT count(*) FROM lineitem) AS row_count,
            (SELECT count(*) FROM (DESCRIBE SELECT * FROM lineitem)) AS column_count""",
        "date_bounds": """SELECT CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date
            FROM orders""",
        "date_bounds_text": """SELECT CAST(min(o_orderdate) AS DATE) AS min_date,
            CAST(max(o_orderdate) AS DATE) AS max_date FROM orders""",
        "weeks_before": """SELECT o_orderkey, CAST(o_orderdate AS DATE) - 28 AS four_weeks,
            CAST(o_orderdate AS DATE) - 56 AS eight_weeks FROM orders""",
        "target_cast": "SELECT doc_id, toxic <> 0 AS toxic, toxic = 0 AS not_toxic FROM labels",
        "target_cast_lenient": """SELECT o_orderkey, CASE WHEN lower(o_orderstatus) IN ('t', 'true', 'y', 'yes', '1') THEN true
            WHEN lower(o_orderstatus) IN ('f', 'false', 'n', 'no', '0') THEN false END AS target FROM orders""",
        "label_projection": "SELECT doc_id, CAST(quality <> 0 AS INTEGER)::DOUBLE AS label FROM labels",
        "target_counts": """SELECT false AS target, count(*) FILTER (WHERE toxic = 0) AS row_count FROM labels
            UNION ALL SELECT true, count(*) FILTER (WHERE toxic <> 0) FROM labels""",
        "temporal_split": f"SELECT o_orderkey, {_split_case('o_orderdate')} AS split FROM orders, {order_days} b",
        "temporal_split_events": f"SELECT event_id, {_split_case('ts')} AS split FROM events, {event_days} b",
        "split_counts": f"SELECT split, row_count FROM ({_spans_sql('orders', 'o_orderdate', 4)})",
        "split_counts_events": f"SELECT split, row_count FROM ({_spans_sql('events', 'ts', 1)})",
        "split_counts_capped": """
            SELECT 'train' AS split, count(*) AS row_count FROM orders
            WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-06-30' - 56
            UNION ALL SELECT 'val', count(*) FROM orders
            WHERE o_orderdate >= DATE '1998-06-30' - 56 AND o_orderdate < DATE '1998-06-30' - 28
            UNION ALL SELECT 'test', count(*) FROM orders
            WHERE o_orderdate >= DATE '1998-06-30' - 28 AND CAST(o_orderdate AS DATE) <= DATE '1998-06-30'""",
        "split_spans": f"""SELECT period, start_date, end_date, row_count
            FROM ({_spans_sql('orders', 'o_orderdate', 4)})""",
        "split_spans_events": f"SELECT period, start_date, end_date, row_count FROM ({_spans_sql('events', 'ts', 1)})",
        "split_filters_lineitem": f"""SELECT {_split_case('l_shipdate')} AS split, count(*) AS row_count,
            CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM lineitem, {line_days} b GROUP BY 1""",
        "num_batches": f"""SELECT count(*) AS row_count, CAST({BATCH_SIZE} AS BIGINT) AS batch_size,
            {by_size} AS num_batches FROM orders""",
        "assign_batches": f"""SELECT o_orderkey, {order_batch} % k AS batch_id
            FROM orders, (SELECT {by_size} AS k FROM orders)""",
        "batch_ledger": _ledger_sql("orders", order_batch, "o_orderstatus = 'F'", BATCH_SIZE),
        "batch_ledger_lineitem": _ledger_sql("lineitem", line_batch, line_label, 100),
        "deal_batches": f"""SELECT (h + i) % 40 AS batch_id, count(*) AS row_count FROM (
            SELECT {_hash_sql("l_linenumber", 42)} AS h, row_number() OVER (PARTITION BY l_linenumber) - 1 AS i FROM lineitem) GROUP BY 1""",
        "class_scores_pos": f"SELECT s AS score FROM {orders} WHERE y",
        "class_scores_neg": f"SELECT s AS score FROM {orders} WHERE NOT y",
        "log_loss": f"SELECT logloss FROM ({_metrics_sql(orders)})",
        "roc_auc": f"SELECT auc FROM ({_metrics_sql(orders)})",
        "average_precision": f"SELECT auprc FROM ({_metrics_sql(orders)})",
        "binary_metrics": f"SELECT logloss, auc, auprc FROM ({_metrics_sql(fine)})",
        "binary_metrics_by_split": f"""SELECT k AS split, logloss, auc, auprc FROM ({_metrics_sql(
            f"(SELECT {_split_case('d')} AS split, y, s FROM {_scored_sql(True, 'events')} e, {event_days} b)", 'split')})""",
        "binary_metrics_undefined": f"""SELECT k AS o_orderpriority, logloss, auc, auprc
            FROM ({_metrics_sql(odd, 'o_orderpriority')})""",
        "roc_curve": _roc_sql(fine, compact=False),
        "roc_curve_compact": _roc_sql(fine, compact=True),
        "score_histogram_pos": f"SELECT * FROM ({histograms}) WHERE target",
        "score_histogram_neg": f"SELECT * FROM ({histograms}) WHERE NOT target",
        "class_histograms": _histogram_sql(f"(SELECT {line_label} AS y, l_extendedprice AS s FROM lineitem)"),
        "synthetic_labeled": """SELECT o_orderkey AS id,
            CAST(round(10 + 990 * CAST(o_orderkey % 10 AS DOUBLE) / 10, 2) AS FLOAT) AS "otherValue",
            DATE '2023-01-01' + CAST(o_orderkey % 365 AS INTEGER) AS "datetimeCol", o_orderkey % 100 = 0 AS "targetCol",
            CAST(CAST('0x' || substr(md5(o_orderkey || '|42|1'), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE * 999 + 1 AS FLOAT) AS feature1,
            CAST(floor(CAST('0x' || substr(md5(o_orderkey || '|42|2'), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE * 775) AS INTEGER) + 3 AS feature2,
            regexp_replace(md5(o_orderkey || '|42|0'), '(.{8})(.{4})(.{4})(.{4})(.{12})', '\\1-\\2-\\3-\\4-\\5') AS reference FROM orders""",
        "predictions_roundtrip": f"""SELECT o_orderkey, y AS target, s AS final_score, {order_batch} % k AS batch_id,
            '20230101000000' AS experiment_id, 'test' AS prefix FROM {orders}, (SELECT {by_size} AS k FROM orders)""",
        "metrics_roundtrip": f"SELECT logloss, auc, auprc FROM ({_metrics_sql(orders)})",
        "impute_indicator": """SELECT event_id, CAST(event_id % 7 = 0 AS INTEGER) AS value_missing,
            CASE WHEN event_id % 7 <> 0 THEN value END AS kept_value,
            CASE WHEN event_id % 7 = 0 THEN true END AS fill_is_median FROM events""",
        "stump_scores": _stumps_sql(1),
        "two_stump_scores": _stumps_sql(2),
        "stump_scores_gaps": _one_stump_sql(
            "CASE WHEN l_orderkey % 3 <> 0 THEN l_discount END", "CASE WHEN l_partkey % 4 <> 0 THEN l_tax END", f"({line_label})", "1"
        ),
        "stump_scores_penalised": _one_stump_sql(
            "l_linenumber", "l_tax", "(l_linenumber >= 6 OR (l_discount >= 0.08) = (l_tax >= 0.06))", "count(*) / 10.0"
        ),
        "train_predict_summary": learned,
        "incremental_summary": learned,
        "predict_saved_model": f"""SELECT event_id, event_type = 'purchase' AS target,
            CASE WHEN event_id % 7 <> 0 THEN value END AS value, {event_batch} % k AS batch_id, true AS has_score
            FROM events, (SELECT {by_size} AS k FROM events)""",
        "report_table": _report_sql(),
        "evaluation_metrics": f"SELECT logloss, auc, auprc FROM ({_metrics_sql(fine)})",
        "run_experiment_one_fit_summary": experiment,
        "run_experiment_summary": experiment,
    } | _text_queries()[1]
