"""Query registry: every operator over the test tables.

Each query takes (spark, sf_dir) and works on the whole ``events`` table there,
brought into the event contract by the adapter. Tables other queries build on
are written once per application and scanned from then on. Operators that need a churn probability get one of two:
``baseline_scores`` is a closed-form logistic expression of the features (so
another engine can recompute it), the trained queries fit a model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import round_to
from clickloom.functions.segments import hot_keys
from clickloom.operators import (
    contracts,
    diagnostics,
    digests,
    experiments,
    features,
    funnel,
    interventions,
    modeling,
    quality,
    reports,
    risk,
    velocity,
)
from clickloom.plans import refresh, stages
from clickloom.plans.oracle import DAMAGE, damaged_value
from clickloom.session import fresh_folder
from clickloom.sources import landing
from clickloom.sources.fixture import read_canonical
from clickloom.sources.loading import load_events
from clickloom.sources.sessions import SessionLayout, write_layout
from clickloom.sources.tables import Warehouse
from clickloom.streaming import continued, incremental

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def _query(name: str):
    def register(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return register


def _over(source: Callable[[SparkSession, str], DataFrame], **named) -> None:
    """Register queries that are one operator over one source."""
    for name, operator in named.items():
        _REGISTRY[name] = lambda spark, sf, op=operator: op(source(spark, sf))


# -------------------------------------------------------------------- sources
# Tables of the running application: (application, sf_dir, table) -> path.
_PATHS: dict[tuple[str, str, str], str] = {}


def _table(name: str):
    """Decorate the definition of a table that other queries build on.

    The first query of an application that needs the table writes it below the
    shared folder; later ones scan it, with their filters and columns pushed
    into the scan. The definition itself stays available as ``fn.compute``.
    """

    def wrap(compute: Query) -> Query:
        def read(spark: SparkSession, sf: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf, name)
            if key not in _PATHS:
                path = fresh_folder(spark, name)
                compute(spark, sf).write.parquet(path)
                _PATHS[key] = path
            return spark.read.parquet(_PATHS[key])

        read.compute = compute
        return read

    return wrap


@_table("events")
def _events(spark: SparkSession, sf: str) -> DataFrame:
    return read_canonical(spark, sf)


_HOT: dict[tuple[str, str], list[str]] = {}


def _hot(spark: SparkSession, sf: str) -> list[str]:
    """Hot sessions of the events table, found once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _HOT:
        _HOT[key] = hot_keys(_events(spark, sf), "session_id")
    return _HOT[key]


def _over_sessions(**named) -> None:
    """Register queries that work on ordered sessions of events."""
    for name, operator in named.items():
        _REGISTRY[name] = lambda spark, sf, op=operator: op(
            _events(spark, sf), _hot(spark, sf)
        )


@_table("session_funnel")
def _funnel(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.session_funnel(_events(spark, sf))


@_table("velocity_metrics")
def _velocity(spark: SparkSession, sf: str) -> DataFrame:
    return velocity.velocity_metrics(_events(spark, sf), _hot(spark, sf))


def _population(spark: SparkSession, sf: str) -> DataFrame:
    return experiments.experiment_population(_events(spark, sf))


def _session_population(spark: SparkSession, sf: str) -> DataFrame:
    return experiments.session_population(_events(spark, sf))


@_table("churn_features")
def _features(spark: SparkSession, sf: str) -> DataFrame:
    return features.churn_features(_events(spark, sf), _hot(spark, sf))


def baseline_probability() -> Column:
    """Closed-form churn probability from observed features, to 6 places."""
    z = (
        F.lit(1.4)
        - F.lit(0.3) * F.col("total_actions_so_far")
        - F.lit(0.2) * F.col("product_views")
        + F.lit(0.9) * F.col("has_cart")
        + F.lit(1.1) * F.col("reached_checkout")
        + F.lit(0.5) * F.col("payment_errors")
        + F.lit(0.0005) * F.col("observed_session_duration_minutes")
    )
    return round_to(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).withColumn("churn_probability", baseline_probability())


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return risk.risk_scores(_scored(spark, sf))


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates carrying payment_errors along instead of joining features back."""
    p = F.col("churn_probability")
    return interventions.intervention_candidates(
        _scored(spark, sf)
        .withColumn("churn_risk_score", p * 100)
        .withColumn("risk_band", risk.risk_band(p))
    )


@_table("intervention_economics")
def _economics(spark: SparkSession, sf: str) -> DataFrame:
    return interventions.intervention_economics(
        _candidates(spark, sf), interventions.session_cart_value(_events(spark, sf))
    )


@_table("intervention_portfolio")
def _portfolio(spark: SparkSession, sf: str) -> DataFrame:
    return interventions.intervention_portfolio(_economics(spark, sf))


def _roi(spark: SparkSession, sf: str) -> DataFrame:
    return interventions.intervention_roi(_portfolio(spark, sf))


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to fixed places: sums in a cluster have no fixed order."""
    return df.select(
        *[
            round_to(F.col(f.name), digits).alias(f.name)
            if f.dataType.simpleString() == "double"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --------------------------------------------------- scans, sinks and catalog
def _flat(events: DataFrame) -> DataFrame:
    """Events with the property struct as plain columns."""
    return events.select(
        *[c for c in events.columns if c not in ("event_properties", "quantity")],
        F.col("quantity").cast("double").alias("quantity"),
        F.col("event_properties.persona").alias("persona"),
        F.col("event_properties.query").alias("query"),
        F.col("event_properties.idle_before_cart_view_seconds").cast("double").alias("idle_seconds"),
    )


_over(_events, scan_events=_flat)


@_query("write_landing")
def _write_landing(spark, sf):
    """Land the events as two micro-batches and read the landing back."""
    events, root = _events(spark, sf), fresh_folder(spark, "landing")
    boundary = F.col("event_name").isin("session_start", "session_end")
    first = F.coalesce(boundary, F.lit(False))  # an event without a name goes with the others
    landing.write_batch(events.where(first), 1, root)
    landing.write_batch(events.where(~first), 2, root)
    return (
        landing.read_events(spark, landing.landing_glob(root))
        .groupBy("event_name")
        .agg(F.count("*").alias("landed_rows"))
    )


def _landed(spark: SparkSession, sf: str) -> str:
    """Landing of two batches with different fields, as producers write them:
    columns that a batch never fills are missing from it, times may be text."""
    events, root = _events(spark, sf), fresh_folder(spark, "landing")
    is_border = F.coalesce(F.col("event_name").isin("session_start", "session_end"), F.lit(False))
    borders = events.where(is_border).drop("cart_value", "query", "category", "page")
    borders = borders.withColumn(
        "event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    landing.write_batch(borders, 1, root)
    landing.write_batch(events.where(~is_border), 2, root)
    return landing.landing_glob(root)


@_query("load_events")
def _load_events(spark, sf):
    """Land, gate and load; the loaded table."""
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    load_events(warehouse, _landed(spark, sf))
    return warehouse.read("events").select("event_id", "session_id", "event_name", "event_timestamp")


@_query("write_table")
def _write_table(spark, sf):
    """Publish a table twice; readers see the second version."""
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    sessions = _funnel(spark, sf)
    warehouse.write("analytics_session_funnel", sessions.where("reached_purchase"))
    return warehouse.write("analytics_session_funnel", sessions)


# --------------------------------------------------------------------- quality
_over(
    _events,
    quality_report=quality.quality_report,
    dataset_overview=quality.dataset_overview,
    event_distribution=quality.event_distribution,
    missing_ids=quality.missing_ids,
    session_boundary=quality.session_boundary,
    unstable_assignment=quality.unstable_assignment,
    inconsistent_users=quality.inconsistent_users,
)
_over_sessions(session_order_check=quality.session_order_check)
_over(_features, null_profile=quality.null_profile)


@_query("load_reconciliation")
def _load_reconciliation(spark, sf):
    glob = _landed(spark, sf)
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"))
    load_events(warehouse, glob)
    return quality.load_reconciliation(
        landing.read_events(spark, glob), warehouse.read("events")
    )


# --------------------------------------------------------- funnel and velocity
_over(
    _events,
    first_step_events=funnel.first_step_events,
    session_funnel=funnel.session_funnel,
    checkout_funnel=funnel.checkout_funnel,
    cart_idle_events=velocity.cart_idle_events,
    cart_idle_sessions=velocity.cart_idle_sessions,
    persona_distribution=velocity.persona_distribution,
    payment_friction=velocity.payment_friction,
)
_over_sessions(
    event_context=velocity.event_context,
    event_velocity=velocity.event_velocity,
    velocity_metrics=velocity.velocity_metrics,
)
_over(
    _funnel,
    funnel_metrics=funnel.funnel_metrics,
    funnel_outcomes=funnel.funnel_outcomes,
    funnel_ordering=funnel.funnel_ordering,
    session_preview=lambda df: reports.preview(df, "session_id", "user_id"),
)
_over(
    _velocity,
    velocity_overview=velocity.velocity_overview,
    session_histogram=lambda df: _rounded(
        reports.session_histogram(df, "session_duration_minutes")
    ),
)


@_query("purchase_consistency")
def _purchase_consistency(spark, sf):
    return funnel.purchase_consistency(_events(spark, sf), _funnel(spark, sf))


@_query("outcome_velocity")
def _outcome_velocity(spark, sf):
    return velocity.outcome_velocity(_funnel(spark, sf), _velocity(spark, sf))


# ----------------------------------------------------------------- experiments
_over(
    _events,
    assign_variant=experiments.assign_variants,
    experiment_population=experiments.experiment_population,
    variant_share=experiments.variant_share,
    session_ab=lambda df: _rounded(experiments.session_ab(df)),
)
_over(
    _population,
    experiment_summary=experiments.experiment_summary,
    population_integrity=experiments.population_integrity,
    conversion_overflow=experiments.conversion_overflow,
)
_over(
    _session_population,
    ab_test=lambda df: _rounded(experiments.ab_test(df)),
    ab_inference=lambda df: _rounded(experiments.analyze_experiment(df)),
    ab_consistency=lambda df: experiments.ab_consistency(experiments.analyze_experiment(df)),
    displayed_lift=lambda df: _rounded(
        experiments.displayed_lift(experiments.experiment_summary(df))
    ),
)


@_query("population_reconciliation")
def _population_reconciliation(spark, sf):
    events = _events(spark, sf)
    return experiments.population_reconciliation(
        events, experiments.experiment_population(events)
    )


# -------------------------------------------------------------------- features
_over(_events, session_outcomes=features.session_outcomes)
_over_sessions(
    ordered_events=lambda df, hot: features.ordered_events(df, hot).withColumn(
        "quantity", F.col("quantity").cast("double")
    ),
    observation_events=lambda df, hot: features.observation_events(df, hot).select(
        "session_id", "user_id", "event_id", "event_name", "event_timestamp", "purchase_timestamp"
    ),
    observation_cutoff=features.observation_cutoff,
    churn_features=features.churn_features,
)
_over(
    _features,
    churn_summary=features.churn_summary,
    churn_distribution=features.churn_distribution,
    feature_summary=features.feature_summary,
    feature_categories=features.feature_categories,
    feature_correlations=lambda df: _rounded(features.feature_correlations(df)),
    high_correlations=lambda df: _rounded(features.high_correlations(df)),
    ml_integrity=contracts.ml_integrity,
    churn_by_device=lambda df: reports.churn_by(df, "device_type"),
    churn_by_source=lambda df: reports.churn_by(df, "traffic_source"),
)

# ------------------------------------------------------- scored data and bands
_over(
    _scored,
    classification_metrics=lambda df: _rounded(diagnostics.classification_metrics(df)),
    roc_auc=lambda df: _rounded(diagnostics.roc_auc(df)),
    classification_report=lambda df: _rounded(diagnostics.classification_report(df)),
    threshold_sweep=lambda df: _rounded(diagnostics.threshold_sweep(df)),
    high_risk_summary=lambda df: _rounded(diagnostics.high_risk_summary(df)),
    brier_score=lambda df: _rounded(diagnostics.brier_score(df)),
    calibration_table=lambda df: _rounded(diagnostics.calibration_table(df)),
    calibration_curve=lambda df: _rounded(diagnostics.calibration_curve(df)),
    probability_summary=lambda df: _rounded(diagnostics.probability_summary(df)),
    risk_bands=lambda df: _rounded(risk.risk_scores(df)),
)
_over(
    _scores,
    risk_distribution=risk.risk_distribution,
    top_risk_sessions=lambda df: _rounded(risk.top_risk_sessions(df)),
    risk_totals=lambda df: _rounded(risk.risk_totals(df)),
    risk_histogram=lambda df: _rounded(reports.risk_histogram(df)),
)

# --------------------------------------------------------------- interventions
@_query("intervention_candidates")
def _intervention_candidates(spark, sf):
    """Through the join of scores and features, as two stored tables meet."""
    scored = _scored(spark, sf)
    joined = interventions.with_payment_errors(risk.risk_scores(scored), scored)
    return _rounded(interventions.intervention_candidates(joined))


_over(
    _candidates,
    action_distribution=interventions.action_distribution,
    priority_distribution=interventions.priority_distribution,
)
_over(_events, session_cart_value=interventions.session_cart_value)
_over(_economics.compute, intervention_economics=_rounded)
_over(
    _economics,
    economics_by_action=interventions.economics_by_action,
    top_opportunities=lambda df: _rounded(interventions.top_opportunities(df)),
    intervention_portfolio=lambda df: _rounded(interventions.intervention_portfolio(df)),
)
_over(
    _portfolio,
    portfolio_by_action=interventions.portfolio_by_action,
    portfolio_totals=interventions.portfolio_totals,
    intervention_roi=lambda df: _rounded(interventions.intervention_roi(df)),
)
_over(
    _roi,
    roi_totals=lambda df: _rounded(interventions.roi_totals(df), 4),
    roi_by_action=lambda df: _rounded(interventions.roi_by_action(df), 4),
    top_roi=lambda df: _rounded(interventions.top_roi(df)),
    portfolio_value_by_action=lambda df: _rounded(reports.portfolio_value_by_action(df), 4),
    action_roi_summary=lambda df: _rounded(reports.action_roi_summary(df), 4),
    portfolio_summary=lambda df: _rounded(reports.portfolio_summary(df), 4),
    top_interventions=reports.top_interventions,
)


# ------------------------------------------------------------------- contracts
@_query("session_reconciliation")
def _session_reconciliation(spark, sf):
    return contracts.session_reconciliation(_features(spark, sf), _scores(spark, sf))


@_query("score_contract")
def _score_contract(spark, sf):
    return _rounded(contracts.score_contract(_features(spark, sf), _scores(spark, sf)))


@_query("candidate_contract")
def _candidate_contract(spark, sf):
    return contracts.candidate_contract(_scores(spark, sf), _candidates(spark, sf))


@_query("roi_contract")
def _roi_contract(spark, sf):
    return contracts.roi_contract(_portfolio(spark, sf), _roi(spark, sf))


def _damaged(table: str, df: DataFrame) -> DataFrame:
    """A copy with sessions missing, repeated and renamed, and bad values."""
    session = F.col("session_id")
    copy = (
        df.where(~session.endswith("-1"))
        .unionByName(df.where(session.endswith("-2")))
        .unionByName(df.where(session.endswith("-3")).withColumn("session_id", F.concat(F.lit("X"), session)))
    )
    return copy.withColumns({c: F.expr(damaged_value(table, c)) for c in DAMAGE[table]})


# Checks and contracts over damaged copies: their counters must find the damage.
_over(
    lambda spark, sf: _damaged("ev", _events(spark, sf)),
    damaged_quality_report=quality.quality_report,
    damaged_missing_ids=quality.missing_ids,
    damaged_session_boundary=quality.session_boundary,
    damaged_unstable_assignment=quality.unstable_assignment,
    damaged_inconsistent_users=quality.inconsistent_users,
)
_over(
    lambda spark, sf: _damaged("feat", _features(spark, sf)),
    damaged_ml_integrity=contracts.ml_integrity,
)


@_query("damaged_session_reconciliation")
def _damaged_session_reconciliation(spark, sf):
    return contracts.session_reconciliation(
        _features(spark, sf), _damaged("score", _scores(spark, sf))
    )


def _score_digests(name: str, report, damaged: bool) -> None:
    def query(spark, sf):
        scores = _scores(spark, sf)
        other = _damaged("score", scores) if damaged else scores
        return report(scores, other, "session_id", ["churn_probability", "churn_risk_score", "risk_band"])

    _REGISTRY[name] = query


_score_digests("damaged_score_differences", digests.differing, True)
_score_digests("damaged_score_digests", digests.reconciliation, True)
_score_digests("score_digests", digests.reconciliation, False)


@_query("damaged_score_contract")
def _damaged_score_contract(spark, sf):
    scores = _damaged("score", _scores(spark, sf))
    return _rounded(contracts.score_contract(_features(spark, sf), scores))


@_query("damaged_candidate_contract")
def _damaged_candidate_contract(spark, sf):
    return contracts.candidate_contract(
        _scores(spark, sf), _damaged("cand", _candidates(spark, sf))
    )


@_query("damaged_roi_contract")
def _damaged_roi_contract(spark, sf):
    return contracts.roi_contract(_portfolio(spark, sf), _damaged("roi", _roi(spark, sf)))


@_query("warehouse_contract")
def _warehouse_contract(spark, sf):
    return contracts.warehouse_contract(
        features=_features(spark, sf),
        scores=_scores(spark, sf),
        candidates=_candidates(spark, sf),
        economics=_economics(spark, sf),
        portfolio=_portfolio(spark, sf),
        roi=_roi(spark, sf),
    )


@_query("executive_kpis")
def _executive_kpis(spark, sf):
    report = reports.executive_kpis(_features(spark, sf), _portfolio(spark, sf), _roi(spark, sf))
    return _rounded(report, 4)


# -------------------------------------------------------------- trained models
_MODELS: dict[tuple[str, str, str], str] = {}


def _model(name: str, spark: SparkSession, sf: str):
    """A model of this application: fitted once, stored in the shared folder.

    ``train`` models see the training part only, ``final`` models all sessions.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MODELS:
        kind, part = name.split("-")
        table = _features(spark, sf)
        rows = modeling.split(table)[0] if part == "train" else table
        fit = {"logistic": modeling.train_logistic, "boosting": modeling.train_boosting}[kind]
        _MODELS[key] = modeling.save_model(fit(rows), fresh_folder(spark, name))
    return modeling.load_model(spark, _MODELS[key])


def _test_part(spark: SparkSession, sf: str) -> DataFrame:
    return modeling.split(_features(spark, sf))[1]


@_query("preprocess")
def _preprocess(spark, sf):
    """The model's inputs, one row a session and place of the vector."""
    ready = modeling.preprocess(_features(spark, sf))
    values = vector_to_array("features")
    return ready.select(
        "session_id", "churned", F.posexplode(values).alias("place", "value")
    ).withColumn("value", round_to(F.col("value"), 6))


@_query("split")
def _split(spark, sf):
    table = _features(spark, sf)
    part = F.when(modeling.in_test_part(table), "test").otherwise("train").alias("part")
    return table.groupBy(part, "churned").agg(F.count("*").alias("sessions"))


@_query("train_lr")
def _train_lr(spark, sf):
    model = _model("logistic-train", spark, sf)
    return modeling.evaluate(modeling.LOGISTIC, model, _test_part(spark, sf))


@_query("train_gbt")
def _train_gbt(spark, sf):
    model = _model("boosting-train", spark, sf)
    return modeling.evaluate(modeling.BOOSTING, model, _test_part(spark, sf))


@_query("lr_coefficients")
def _lr_coefficients(spark, sf):
    return modeling.coefficients(spark, _model("logistic-final", spark, sf))


@_query("compare_models")
def _compare_models(spark, sf):
    fitted = {
        modeling.LOGISTIC: _model("logistic-train", spark, sf),
        modeling.BOOSTING: _model("boosting-train", spark, sf),
    }
    return modeling.compare_fitted(fitted, _test_part(spark, sf))


@_query("train_final")
def _train_final(spark, sf):
    """Train on every session, save, and describe the artifact."""
    _model("boosting-final", spark, sf)
    path = _MODELS[spark.sparkContext.applicationId, sf, "boosting-final"]
    return _features(spark, sf).agg(
        F.count("*").alias("training_sessions"),
        F.lit(len(S.FEATURE_COLUMNS)).alias("features"),
        F.lit(modeling.model_exists(spark, path)).alias("model_saved"),
    )


@_query("churn_risk_scores")
def _churn_risk_scores(spark, sf):
    return modeling.score_sessions(_model("boosting-final", spark, sf), _features(spark, sf))


@_query("churn_risk_check")
def _churn_risk_check(spark, sf):
    """What must hold of the scores of any model."""
    scores = _churn_risk_scores(spark, sf)
    low, medium, high = (100 * cut for cut in S.RISK_CUTS)
    score = F.col("churn_risk_score")
    names = [(low, "low"), (medium, "medium"), (high, "high")]
    band = F.lit("critical")
    for cut, name in reversed(names):
        band = F.when(score < cut, name).otherwise(band)
    return scores.agg(
        F.count("*").alias("sessions"),
        F.count_if(~score.between(0, 100) | score.isNull()).alias("outside_range"),
        F.count_if(F.col("risk_band") != band).alias("wrong_band"),
    )


@_query("model_roundtrip")
def _model_roundtrip(spark, sf):
    """Sessions whose score differs between a model and its loaded copy."""
    table = _features(spark, sf)
    model = _model("logistic-final", spark, sf)
    copy = modeling.load_model(spark, modeling.save_model(model, fresh_folder(spark, "model")))
    both = modeling.with_probability(model, table).withColumnRenamed(
        "churn_probability", "before"
    )
    both = modeling.with_probability(copy, both)
    return both.agg(
        F.count("*").alias("sessions"),
        F.count_if(F.col("before") != F.col("churn_probability")).alias("changed_scores"),
    )


# ------------------------------------------------------------------- streaming
@_query("incremental_load")
def _incremental_load(spark, sf):
    """Events landed twice, loaded once each by the deduplicating stream."""
    events, root = _events(spark, sf), fresh_folder(spark, "landing")
    for number in (1, 2):
        landing.write_batch(events, number, root)
    stream = incremental.landing_stream(spark, landing.landing_glob(root))
    table = fresh_folder(spark, "incremental")
    incremental.append_events(
        incremental.deduplicated(stream), table, fresh_folder(spark, "stream")
    ).awaitTermination()
    return (
        spark.read.parquet(table).groupBy("event_name").agg(F.count("*").alias("loaded_rows"))
    )


@_query("gated_stream")
def _gated_stream(spark, sf):
    """Events accepted from the first batch and refused from its repetition."""
    events, root = _events(spark, sf), fresh_folder(spark, "landing")
    accepted, refused, reports, log = (
        fresh_folder(spark, name) for name in ("accepted", "refused", "reports", "stream")
    )
    for number in (1, 2):
        landing.write_batch(events, number, root)
        stream = incremental.landing_stream(spark, landing.landing_glob(root))
        incremental.gated_load(stream, accepted, refused, reports, log).awaitTermination()
    sides = [(accepted, "accepted"), (refused, "refused")]
    counted = [
        spark.read.parquet(path)
        .groupBy(F.lit(name).alias("side"), "event_name")
        .agg(F.count("*").alias("events"))
        for path, name in sides
    ]
    return counted[0].unionByName(counted[1])


def _much_later(events):
    """One event that closes all sessions before it."""
    return landing.conform(
        events.agg(F.expr("max(event_timestamp) + interval 30 days").alias("event_timestamp"))
        .withColumns({"session_id": F.lit("later"), "event_id": F.lit("later")})
        .withColumn("event_name", F.lit("homepage_view"))
    )


@_query("stream_funnel")
def _stream_funnel(spark, sf):
    """Funnel rows of the stream once a much later event has closed all sessions."""
    events, root = _events(spark, sf), fresh_folder(spark, "landing")
    later = _much_later(events)
    table, log = fresh_folder(spark, "incremental"), fresh_folder(spark, "stream")
    for number, batch in enumerate((events, later, later), start=1):
        landing.write_batch(batch, number, root)
        stream = incremental.landing_stream(spark, landing.landing_glob(root))
        # sessions of the test table are never quiet for more than 12 hours
        closed = incremental.rolling_funnel(stream, gap="13 hours")
        incremental.append_events(closed, table, log).awaitTermination()
    return spark.read.parquet(table)


@_query("continued_funnel")
def _continued_funnel(spark, sf):
    """Last versions of sessions published after half an hour of quiet, corrected as
    they go on; landed by day, and the stream starts anew for each landing."""
    events, root = _events(spark, sf), fresh_folder(spark, "landing")
    table, log = fresh_folder(spark, "versions"), fresh_folder(spark, "stream")
    first, last = events.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    parts, width = 3, (last - first) / 3
    batches = []
    for i in range(parts):
        at = F.col("event_timestamp")
        since = at >= F.lit(first + i * width) if i else F.lit(True)
        batches.append(events.where(since & (at < F.lit(first + (i + 1) * width) if i < parts - 1 else F.lit(True))))
    later = _much_later(events)
    for number, batch in enumerate((*batches, later, later), start=1):
        landing.write_batch(batch, number, root)
        stream = incremental.landing_stream(spark, landing.landing_glob(root))
        # sessions of the test table are never quiet for more than 12 hours
        versions = continued.funnel_versions(stream, keep="13 hours")
        incremental.append_events(versions, table, log).awaitTermination()
    return continued.latest_funnel(spark.read.parquet(table))


# ----------------------------------------------- sessions laid out or refreshed
_LAYOUTS: dict[tuple[str, str], SessionLayout] = {}


def _layout(spark: SparkSession, sf: str) -> SessionLayout:
    """The events by session, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAYOUTS:
        _LAYOUTS[key] = write_layout(_events(spark, sf), fresh_folder(spark, "sessions"), _hot(spark, sf))
    return _LAYOUTS[key]


for _name, _table_of in refresh.SESSION_TABLES.items():
    _short = {"analytics_churn_feature_dataset": "churn_features"}.get(_name, _name.removeprefix("analytics_"))
    _REGISTRY[f"laid_out_{_short}"] = lambda spark, sf, table=_table_of: _layout(spark, sf).per_session(
        spark, lambda events, hot, seconds: table(events, hot)
    )
    _REGISTRY[f"refreshed_{_short}"] = lambda spark, sf, name=_name: _refreshed(spark, sf).table(name)

_REFRESHED: dict[tuple[str, str], refresh.IncrementalWarehouse] = {}


def _refreshed(spark: SparkSession, sf: str) -> refresh.IncrementalWarehouse:
    """Session tables after two landings, the second holding the last three days."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _REFRESHED:
        events, root = _events(spark, sf), fresh_folder(spark, "landing")
        warehouse = refresh.IncrementalWarehouse(spark, fresh_folder(spark, "warehouse"))
        day = F.to_date("event_timestamp")
        last = events.agg(F.max(day)).first()[0]
        recent = day > F.date_sub(F.lit(last), 3)
        for number, part in enumerate((events.where(~recent), events.where(recent)), start=1):
            warehouse.land(landing.write_batch(part, number, root))
            warehouse.refresh()
        _REFRESHED[key] = warehouse
    return _REFRESHED[key]


# ------------------------------------------------------------------ whole runs
@_query("end_to_end_run")
def _end_to_end_run(spark, sf):
    """All eleven stages on a new warehouse, then the contract's row."""
    run = stages.Run(
        Warehouse(spark, fresh_folder(spark, "warehouse")),
        [_landed(spark, sf)],
        fresh_folder(spark, "model"),
        inference_unit="session",  # every test user converts
    )
    stages.run_stages(run)
    return stages.check_warehouse(run)


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)
