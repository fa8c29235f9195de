"""Variant assignment, experiment populations and conversion inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.functions.columns import flag, is_event, share, side_by_side, tally
from clickloom.functions.stats import critical_value, two_sided_p

CONTROL, TREATMENT = S.VARIANTS


# ------------------------------------------------------------------ assignment
def assignment_bucket(user_id: Column, experiment_id: Column) -> Column:
    """0..99: the first 64 bits of SHA-256("user:experiment") modulo 100."""
    digest = F.sha2(F.concat_ws(":", user_id, experiment_id), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)") % 100


def assigned_variant(user_id: Column, experiment_id: Column) -> Column:
    return F.when(assignment_bucket(user_id, experiment_id) < 50, CONTROL).otherwise(TREATMENT)


def assign_variants(users: DataFrame, experiment_id: str = S.DEFAULT_EXPERIMENT_ID) -> DataFrame:
    """user_id, experiment_id and variant for every distinct user."""
    return (
        users.select("user_id")
        .distinct()
        .withColumn("experiment_id", F.lit(experiment_id))
        .withColumn("variant", assigned_variant(F.col("user_id"), F.col("experiment_id")))
    )


# ------------------------------------------------------------------ population
def experiment_population(events: DataFrame) -> DataFrame:
    """Users with one variant who saw the homepage, and whether they purchased.

    One pass: events fold to (user, assigned variant) with two flags, then to
    users. Eligibility and conversion look at all events of the user, the
    variant only at events carrying an experiment.
    """
    assigned = F.when(F.col("experiment_id").isNotNull(), F.col("variant"))
    in_experiment = F.col("experiment_id").isNotNull()
    return (
        events.groupBy("user_id", assigned.alias("variant"))
        .agg(
            F.max(flag(in_experiment)).alias("assigned"),
            F.max(flag(is_event("homepage_view"))).alias("eligible"),
            F.max(flag(is_event("purchase_complete"))).alias("purchased"),
        )
        .groupBy("user_id")
        .agg(
            F.min("variant").alias("variant"),
            F.count("variant").alias("variants"),
            F.max("assigned").alias("assigned"),
            F.max("eligible").alias("eligible"),
            F.max("purchased").alias("purchased"),
        )
        .where(
            F.col("user_id").isNotNull()
            & (F.col("variants") == 1)
            & (F.col("assigned") == 1)
            & (F.col("eligible") == 1)
        )
        .select("user_id", "variant", (F.col("purchased") == 1).alias("converted"))
    )


def session_population(events: DataFrame) -> DataFrame:
    """The same shape with sessions as units: session_id, variant, converted."""
    return (
        events.groupBy("session_id", "variant")
        .agg(F.max(flag(is_event("purchase_complete"))).alias("purchased"))
        .groupBy("session_id")
        .agg(F.max("variant").alias("variant"), F.max("purchased").alias("purchased"))
        .select("session_id", "variant", (F.col("purchased") == 1).alias("converted"))
    )


def _by_variant(population: DataFrame, units: str = "users") -> DataFrame:
    return population.groupBy("variant").agg(
        F.count("*").alias(units), tally(F.col("converted")).alias("conversions")
    )


def experiment_summary(population: DataFrame) -> DataFrame:
    return (
        _by_variant(population)
        .withColumn("conversion_rate_pct", share(F.col("conversions"), F.col("users")))
        .orderBy("variant")
    )


def displayed_lift(summary: DataFrame) -> DataFrame:
    """Lift between the first two variants, from their displayed percentages."""
    rate = F.col("conversion_rate_pct")
    place = F.row_number().over(Window.orderBy("variant"))  # one row per variant
    pair = (
        summary.withColumn("place", place)
        .agg(
            F.max(F.when(F.col("place") == 1, rate)).alias("control"),
            F.max(F.when(F.col("place") == 2, rate)).alias("treatment"),
        )
        .where(F.col("treatment").isNotNull())
    )
    lift = F.col("treatment") - F.col("control")
    return pair.select(
        lift.alias("absolute_lift"),
        F.when(F.col("control") > 0, lift / F.col("control") * 100)
        .otherwise(0.0)
        .alias("relative_lift"),
    )


def variant_share(events: DataFrame) -> DataFrame:
    """Distinct users by variant and their share of the summed counts."""
    counts = (
        events.select("variant", "user_id")
        .distinct()
        .groupBy("variant")
        .agg(F.count("user_id").alias("users"))
    )
    total = F.sum("users").over(Window.partitionBy())  # one row per variant
    return counts.withColumn("user_percentage", share(F.col("users"), total)).orderBy("variant")


def session_ab(events: DataFrame) -> DataFrame:
    """Sessions, conversions and rate by variant; lifts against control."""
    rates = _by_variant(session_population(events), "sessions").withColumn(
        "conversion_rate_pct", share(F.col("conversions"), F.col("sessions"), 3)
    )
    rate = F.col("conversion_rate_pct")
    all_rows = Window.partitionBy()  # one row per variant
    base = F.max(F.when(F.col("variant") == CONTROL, rate)).over(all_rows)
    other = F.max(F.when(F.col("variant") == TREATMENT, rate)).over(all_rows)
    return (
        rates.withColumn("absolute_lift", other - base)
        .withColumn(
            "relative_lift_pct", F.when(base > 0, (other / base - 1) * 100).otherwise(0.0)
        )
        .orderBy("variant")
    )


# ------------------------------------------------------------------- integrity
def population_integrity(population: DataFrame) -> DataFrame:
    return population.agg(
        F.count("*").alias("total_rows"), F.count_distinct("user_id").alias("distinct_users")
    ).withColumn("duplicate_users", F.col("total_rows") - F.col("distinct_users"))


def population_reconciliation(events: DataFrame, population: DataFrame) -> DataFrame:
    assigned = events.where(F.col("experiment_id").isNotNull())
    return side_by_side(
        assigned.agg(F.count_distinct("user_id").alias("experiment_assigned_users")),
        population.agg(F.count("*").alias("eligible_population_users")),
    ).withColumn(
        "is_consistent",
        F.col("eligible_population_users") <= F.col("experiment_assigned_users"),
    )


def conversion_overflow(population: DataFrame) -> DataFrame:
    """Variants with more conversions than users; empty when consistent."""
    return _by_variant(population).where(F.col("conversions") > F.col("users"))


# ------------------------------------------------------------------- inference
def _variant_pair(population: DataFrame) -> DataFrame:
    """One row with users and conversions of both variants.

    Fails the job unless the variants are exactly control and treatment.
    """
    variant = F.col("variant")
    counts = _by_variant(population).agg(
        F.sum(F.when(variant == CONTROL, F.col("users"))).alias("control_users"),
        F.sum(F.when(variant == TREATMENT, F.col("users"))).alias("treatment_users"),
        F.sum(F.when(variant == CONTROL, F.col("conversions"))).alias("control_conversions"),
        F.sum(F.when(variant == TREATMENT, F.col("conversions"))).alias("treatment_conversions"),
        F.count("*").alias("groups"),
    )
    complete = (
        (F.col("groups") == 2)
        & F.col("control_users").isNotNull()
        & F.col("treatment_users").isNotNull()
    )
    broken = F.raise_error(F.lit("an experiment needs exactly control and treatment")).cast("long")
    guarded = F.when(complete, F.col("control_users")).otherwise(broken)
    return counts.withColumn("control_users", guarded).drop("groups")


def ab_test(population: DataFrame, confidence_level: float = 0.95) -> DataFrame:
    """Closed-form inference on two proportions: rates, lifts, z, chi-square, CI.

    ``population`` has columns variant and converted. z pools the variance,
    the interval does not.
    """
    if not 0 < confidence_level < 1:
        raise ValueError("confidence_level must be between 0 and 1")
    critical = F.lit(critical_value(confidence_level))

    nc, nt = F.col("control_users").cast("double"), F.col("treatment_users").cast("double")
    xc, xt = (
        F.col("control_conversions").cast("double"),
        F.col("treatment_conversions").cast("double"),
    )
    rc, rt = F.col("control_conversion_rate"), F.col("treatment_conversion_rate")
    lift = F.col("absolute_lift")

    pooled = (xc + xt) / (nc + nt)
    pooled_se = F.sqrt(pooled * (1 - pooled) * (1 / nc + 1 / nt))
    flat = F.raise_error(F.lit("no inference with zero variance")).cast("double")
    checked_se = F.when(pooled_se > 0, pooled_se).otherwise(flat)

    # 2x2 chi-square without continuity correction: n (ad - bc)^2 / margins
    cross = xc * (nt - xt) - xt * (nc - xc)
    converted, lost = xc + xt, (nc - xc) + (nt - xt)
    chi_square = (nc + nt) * cross * cross / (nc * nt * converted * lost)

    spread = critical * F.sqrt(rc * (1 - rc) / nc + rt * (1 - rt) / nt)
    return (
        _variant_pair(population)
        .withColumn("control_conversion_rate", xc / nc)
        .withColumn("treatment_conversion_rate", xt / nt)
        .withColumn("absolute_lift", rt - rc)
        .withColumn(
            "relative_lift", F.when(rc > 0, F.try_divide(lift, rc)).otherwise(F.lit(float("nan")))
        )
        .withColumn("z_statistic", lift / checked_se)
        .withColumn("chi_square_statistic", chi_square)
        .withColumn("confidence_interval_lower", lift - spread)
        .withColumn("confidence_interval_upper", lift + spread)
    )


def analyze_experiment(
    population: DataFrame,
    significance_level: float = 0.05,
    confidence_level: float = 0.95,
) -> DataFrame:
    """The full inference record: ``ab_test`` plus p-values and the decision."""
    if not 0 < significance_level < 1:
        raise ValueError("significance_level must be between 0 and 1")
    significant, lift = F.col("statistically_significant"), F.col("absolute_lift")
    # Fixed texts of the decision.
    decision = (
        F.when(
            significant & (lift > 0), "Treatment outperforms Control. Recommend rollout."
        )
        .when(
            significant & (lift < 0), "Treatment underperforms Control. Do not roll out."
        )
        .otherwise(
            "No statistically significant evidence of improvement. Continue experiment."
        )
    )
    return (
        ab_test(population, confidence_level)
        .withColumn("z_test_p_value", two_sided_p("z_statistic"))
        # one degree of freedom: the tail of chi-square is that of |Z| = sqrt(x)
        .withColumn("chi_square_p_value", two_sided_p(F.sqrt("chi_square_statistic")))
        .withColumn("statistically_significant", F.col("z_test_p_value") < significance_level)
        .withColumn("recommendation", decision)
        .select(
            "control_users",
            "treatment_users",
            "control_conversions",
            "treatment_conversions",
            "control_conversion_rate",
            "treatment_conversion_rate",
            "absolute_lift",
            "relative_lift",
            "z_statistic",
            "z_test_p_value",
            "chi_square_statistic",
            "chi_square_p_value",
            "confidence_interval_lower",
            "confidence_interval_upper",
            "statistically_significant",
            "recommendation",
        )
    )


def ab_consistency(result: DataFrame) -> DataFrame:
    """Whether "interval contains zero" and "not significant" agree."""
    contains_zero = (F.col("confidence_interval_lower") <= 0) & (
        F.col("confidence_interval_upper") >= 0
    )
    return result.select(
        "statistically_significant",
        contains_zero.alias("interval_contains_zero"),
        (F.col("statistically_significant") != contains_zero).alias("is_consistent"),
    )
