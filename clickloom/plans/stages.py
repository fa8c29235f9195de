"""The ordered run over a warehouse: one application, one table per stage."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from clickloom import schema as S
from clickloom.functions.segments import hot_keys
from clickloom.operators import (
    contracts,
    experiments,
    features,
    funnel,
    interventions,
    modeling,
    velocity,
)
from clickloom.sources.loading import load_events
from clickloom.sources.tables import Warehouse


@dataclass
class Run:
    """What the stages share: the tables and the run's parameters.

    Stages hand over through published tables, so each one starts from a
    short lineage and a lost executor costs only the stage in progress.
    """

    warehouse: Warehouse
    landing: Sequence[str]
    model_path: str
    capacity: int = S.DEFAULT_CAPACITY
    boosting_rounds: int = 200
    significance_level: float = 0.05
    confidence_level: float = 0.95
    inference_unit: str = "user"
    results: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.warehouse.read(name)

    def hot_sessions(self) -> list[str]:
        """Hot sessions of the loaded events, found once per run."""
        if "hot_sessions" not in self.results:
            self.results["hot_sessions"] = hot_keys(self.table("events"), "session_id")
        return self.results["hot_sessions"]

    def publish(self, name: str, df: DataFrame) -> None:
        self.warehouse.write(name, df)


def load(run: Run) -> None:
    run.results["quality"] = load_events(run.warehouse, *run.landing)
    run.results.pop("hot_sessions", None)


def behavioral(run: Run) -> None:
    """The three behavioral tables, in dependency order."""
    events = run.table("events")
    run.publish("analytics_session_funnel", funnel.session_funnel(events))
    run.publish(
        "analytics_funnel_metrics", funnel.funnel_metrics(run.table("analytics_session_funnel"))
    )
    run.publish(
        "analytics_velocity_metrics", velocity.velocity_metrics(events, run.hot_sessions())
    )


def experiment_population(run: Run) -> None:
    run.publish(
        "analytics_experiment_population", experiments.experiment_population(run.table("events"))
    )


def experiment_analysis(run: Run) -> None:
    """Inference over users, or over sessions where every user converts."""
    if run.inference_unit == "session":
        population = experiments.session_population(run.table("events"))
    else:
        population = run.table("analytics_experiment_population")
    record = experiments.analyze_experiment(
        population, run.significance_level, run.confidence_level
    )
    run.results["experiment"] = record.first()


def churn_features(run: Run) -> None:
    run.publish(
        "analytics_churn_feature_dataset",
        features.churn_features(run.table("events"), run.hot_sessions()),
    )


def train_model(run: Run) -> None:
    model = modeling.train_boosting(
        run.table("analytics_churn_feature_dataset"), run.boosting_rounds
    )
    modeling.save_model(model, run.model_path)


def risk_scores(run: Run) -> None:
    model = modeling.load_model(run.warehouse.spark, run.model_path)
    run.publish(
        "analytics_churn_risk_scores",
        modeling.score_sessions(model, run.table("analytics_churn_feature_dataset")),
    )


def candidates(run: Run) -> None:
    scored = interventions.with_payment_errors(
        run.table("analytics_churn_risk_scores"), run.table("analytics_churn_feature_dataset")
    )
    run.publish(
        "analytics_intervention_candidates", interventions.intervention_candidates(scored)
    )


def economics(run: Run) -> None:
    values = interventions.session_cart_value(run.table("events"))
    run.publish(
        "analytics_intervention_economics",
        interventions.intervention_economics(
            run.table("analytics_intervention_candidates"), values
        ),
    )


def portfolio(run: Run) -> None:
    run.publish(
        "analytics_intervention_portfolio",
        interventions.intervention_portfolio(
            run.table("analytics_intervention_economics"), run.capacity
        ),
    )


def roi(run: Run) -> None:
    run.publish(
        "analytics_intervention_roi",
        interventions.intervention_roi(run.table("analytics_intervention_portfolio")),
    )


STAGES: tuple[tuple[str, Callable[[Run], None]], ...] = (
    ("load", load),
    ("behavioral", behavioral),
    ("experiment_population", experiment_population),
    ("experiment_analysis", experiment_analysis),
    ("churn_features", churn_features),
    ("train_model", train_model),
    ("risk_scores", risk_scores),
    ("candidates", candidates),
    ("economics", economics),
    ("portfolio", portfolio),
    ("roi", roi),
)


def run_stages(run: Run, stages: Sequence[tuple[str, Callable[[Run], None]]] = STAGES) -> list[str]:
    """Run the stages in order; the first failure stops the run."""
    done = []
    for name, stage in stages:
        try:
            stage(run)
        except Exception as error:
            raise RuntimeError(f"stage failed: {name}") from error
        done.append(name)
    return done


def check_warehouse(run: Run) -> DataFrame:
    """Tables and model present, then the contract over the session tables."""
    run.warehouse.require_tables(S.WAREHOUSE_TABLES)
    if not modeling.model_exists(run.warehouse.spark, run.model_path):
        raise contracts.ContractError(f"no churn model at {run.model_path}")
    report = contracts.warehouse_contract(
        *[
            run.table(name)
            for name in (
                "analytics_churn_feature_dataset",
                "analytics_churn_risk_scores",
                "analytics_intervention_candidates",
                "analytics_intervention_economics",
                "analytics_intervention_portfolio",
                "analytics_intervention_roi",
            )
        ],
        capacity=run.capacity,
    )
    return contracts.require(report, "warehouse contract failed")
