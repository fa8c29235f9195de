"""The queries once more as plain SQL, for a second engine to recompute.

Each statement is a chain of named fragments over the test table ``events``
and a final SELECT. The statements are written for clarity, not for scale.
"""

from __future__ import annotations

import re

from clickloom import schema as S
from clickloom.functions.stats import critical_value
from clickloom.sources.fixture import CART_EVENTS, PERSONAS, SESSION_GAP_SECONDS, TRAFFIC_SOURCES


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _mean(column: str) -> str:
    """Mean of values with 2 places, through whole hundredths."""
    return f"round(sum(CAST(round({column} * 100) AS BIGINT)) / (count({column}) * 100), 2)"


def _minutes(start: str, end: str) -> str:
    return f"(epoch({end} - {start}) / 60.0)"


# name -> (fragments it reads, SQL)
_FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _fragment(name: str, needs: tuple[str, ...], sql: str) -> None:
    _FRAGMENTS[name] = (needs, sql.strip())


_fragment(
    "spaced",
    (),
    f"""
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract(props, '$.k') AS INTEGER) AS k,
           coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) > {SESSION_GAP_SECONDS * 1_000_000}, true)
             AS opens
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
_fragment(
    "sessioned",
    ("spaced",),
    """
    SELECT *, user_id || '-' || CAST(sum(CAST(opens AS INTEGER)) OVER (
             PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
             AS session_id
    FROM spaced
    """,
)
_fragment(
    "all_rows",
    ("sessioned",),
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, session_id, ts, value, k,
           CASE event_type
             WHEN 'view' THEN CASE k % 2 WHEN 0 THEN 'homepage_view' ELSE 'product_view' END
             WHEN 'click' THEN CASE k % 4 WHEN 2 THEN 'search' WHEN 3 THEN 'wishlist_add'
                                          ELSE 'product_click' END
             WHEN 'signup' THEN CASE k % 4 WHEN 2 THEN 'cart_view' WHEN 3 THEN 'checkout_start'
                                           ELSE 'add_to_cart' END
             WHEN 'error' THEN CASE k % 2 WHEN 0 THEN 'payment_attempt' ELSE 'payment_error' END
             WHEN 'purchase' THEN 'purchase_complete' END AS event_name
    FROM sessioned
    UNION ALL
    SELECT 'S-' || session_id, user_id, session_id, min(ts) - INTERVAL 1 SECOND, NULL, NULL,
           'session_start'
    FROM sessioned GROUP BY user_id, session_id
    UNION ALL
    SELECT 'E-' || session_id, user_id, session_id, max(ts) + INTERVAL 1 SECOND, NULL, NULL,
           'session_end'
    FROM sessioned GROUP BY user_id, session_id
    """,
)
_fragment(
    "ev",
    ("all_rows",),
    f"""
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, session_id,
           ts AS event_timestamp, event_name,
           CASE WHEN user_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device_type,
           ([{_list(TRAFFIC_SOURCES)}])[user_id % 5 + 1] AS traffic_source,
           CASE WHEN event_name IN ({_list(CART_EVENTS)}) THEN value END AS cart_value,
           '{S.DEFAULT_EXPERIMENT_ID}' AS experiment_id,
           CASE WHEN CAST('0x' || substr(sha256(user_id || ':{S.DEFAULT_EXPERIMENT_ID}'), 1, 16)
                          AS UBIGINT) % 100 < 50
                THEN 'control' ELSE 'treatment' END AS variant,
           CASE WHEN event_name = 'session_start'
                THEN ([{_list(PERSONAS)}])[user_id % 6 + 1] END AS persona,
           CASE WHEN event_name = 'cart_view' THEN CAST(k * 10 AS BIGINT) END AS idle_seconds
    FROM all_rows
    """,
)

# ------------------------------------------------------------------- behavior
_fragment(
    "firsts",
    ("ev",),
    f"""
    SELECT session_id, user_id, event_name, event_id, event_timestamp
    FROM ev WHERE event_name IN ({_list(S.FUNNEL_STEPS)})
    QUALIFY row_number() OVER (
      PARTITION BY session_id, event_name ORDER BY event_timestamp, event_id) = 1
    """,
)
_fragment(
    "fun",
    ("firsts",),
    """
    SELECT *,
           homepage_view_at IS NOT NULL AS reached_homepage,
           product_click_at IS NOT NULL AS reached_product_click,
           add_to_cart_at IS NOT NULL AS reached_cart,
           purchase_complete_at IS NOT NULL AS reached_purchase,
           CASE WHEN purchase_complete_at IS NOT NULL THEN 'purchased'
                WHEN add_to_cart_at IS NOT NULL THEN 'cart_abandoned'
                WHEN product_click_at IS NOT NULL THEN 'product_abandoned'
                ELSE 'homepage_abandoned' END AS funnel_outcome
    FROM (SELECT session_id, user_id,
                 min(event_timestamp) FILTER (event_name = 'homepage_view') AS homepage_view_at,
                 min(event_timestamp) FILTER (event_name = 'product_click') AS product_click_at,
                 min(event_timestamp) FILTER (event_name = 'add_to_cart') AS add_to_cart_at,
                 min(event_timestamp) FILTER (event_name = 'purchase_complete')
                   AS purchase_complete_at
          FROM firsts GROUP BY ALL)
    """,
)
_fragment(
    "ctx",
    ("ev",),
    """
    SELECT session_id, user_id, event_id, event_name, event_timestamp,
           lag(event_timestamp) OVER w AS previous_event_timestamp,
           lag(event_name) OVER w AS previous_event_name,
           lead(event_timestamp) OVER w AS next_event_timestamp,
           lead(event_name) OVER w AS next_event_name
    FROM ev WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)
    """,
)
_fragment(
    "gaps",
    ("ctx",),
    f"""
    SELECT session_id, user_id, event_name, event_timestamp, previous_event_name, next_event_name,
           round({_minutes('previous_event_timestamp', 'event_timestamp')}, 2)
             AS minutes_since_previous_event,
           round({_minutes('event_timestamp', 'next_event_timestamp')}, 2)
             AS minutes_to_next_event
    FROM ctx
    """,
)
_fragment(
    "vel",
    ("gaps",),
    f"""
    SELECT session_id, user_id, count(*) AS total_events,
           round({_minutes('min(event_timestamp)', 'max(event_timestamp)')}, 2)
             AS session_duration_minutes,
           {_mean('minutes_since_previous_event')} AS average_event_gap_minutes,
           round(max(minutes_since_previous_event), 2) AS maximum_event_gap_minutes,
           {_mean('minutes_to_next_event')} AS average_next_event_gap_minutes
    FROM gaps GROUP BY session_id, user_id
    """,
)

# ----------------------------------------------------------------- experiments
_fragment(
    "pop",
    ("ev",),
    """
    SELECT user_id, min(variant) FILTER (experiment_id IS NOT NULL) AS variant,
           bool_or(event_name = 'purchase_complete') AS converted
    FROM ev GROUP BY user_id
    HAVING count(DISTINCT variant) FILTER (experiment_id IS NOT NULL) = 1
       AND bool_or(event_name = 'homepage_view')
    """,
)
_fragment(
    "spop",
    ("ev",),
    """
    SELECT session_id, max(variant) AS variant,
           bool_or(event_name = 'purchase_complete') AS converted
    FROM ev GROUP BY session_id
    """,
)

# -------------------------------------------------------------------- features
_fragment(
    "outcome",
    ("ev",),
    """
    SELECT session_id,
           CAST(bool_or(event_name = 'purchase_complete') AS INTEGER) AS purchased,
           min(event_timestamp) FILTER (event_name = 'purchase_complete') AS purchase_timestamp
    FROM ev GROUP BY session_id
    """,
)
_fragment(
    "obs",
    ("ev", "outcome"),
    """
    SELECT ev.*, purchase_timestamp
    FROM ev JOIN outcome USING (session_id)
    WHERE event_name NOT IN ('purchase_complete', 'session_end')
      AND coalesce(event_timestamp < purchase_timestamp, true)
    """,
)
_fragment(
    "cut",
    ("obs",),
    """
    SELECT session_id, event_timestamp AS observation_timestamp, user_id, device_type,
           traffic_source
    FROM obs
    QUALIFY row_number() OVER (PARTITION BY session_id
      ORDER BY event_timestamp DESC, user_id DESC, device_type DESC, traffic_source DESC) = 1
    """,
)
_fragment(
    "feat",
    ("ev", "cut", "outcome"),
    f"""
    SELECT cut.user_id, session_id, observation_timestamp, purchased,
           count(*) AS total_actions_so_far,
           count(DISTINCT event_name) AS unique_event_types,
           count(*) FILTER (event_name = 'product_view') AS product_views,
           count(*) FILTER (event_name = 'add_to_cart') AS add_to_cart_actions,
           count(*) FILTER (event_name = 'cart_view') AS cart_views,
           count(*) FILTER (event_name = 'checkout_start') AS checkout_starts,
           count(*) FILTER (event_name = 'payment_attempt') AS payment_attempts,
           count(*) FILTER (event_name = 'payment_error') AS payment_errors,
           CAST(bool_or(event_name = 'add_to_cart') AS INTEGER) AS has_cart,
           CAST(bool_or(event_name = 'checkout_start') AS INTEGER) AS reached_checkout,
           min(event_timestamp) AS session_start_timestamp,
           max(event_timestamp) AS latest_event_timestamp,
           round({_minutes('min(event_timestamp)', 'max(event_timestamp)')}, 4)
             AS observed_session_duration_minutes,
           cut.device_type, cut.traffic_source, 1 - purchased AS churned
    FROM cut JOIN outcome USING (session_id) JOIN ev USING (session_id)
    WHERE ev.user_id = cut.user_id AND event_timestamp <= observation_timestamp
    GROUP BY ALL
    """,
)

# ------------------------------------------------------- scores and decisions
_fragment(
    "scored",
    ("feat",),
    """
    SELECT *, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(1.4::DOUBLE
             - 0.3::DOUBLE * total_actions_so_far - 0.2::DOUBLE * product_views
             + 0.9::DOUBLE * has_cart + 1.1::DOUBLE * reached_checkout
             + 0.5::DOUBLE * payment_errors
             + 0.0005::DOUBLE * observed_session_duration_minutes))), 6) AS churn_probability
    FROM feat
    """,
)
_fragment(
    "score",
    ("scored",),
    f"""
    SELECT user_id, session_id, observation_timestamp, has_cart, reached_checkout, purchased,
           churn_probability, churn_probability * 100 AS churn_risk_score,
           CASE WHEN churn_probability < {S.RISK_CUTS[0]} THEN 'low'
                WHEN churn_probability < {S.RISK_CUTS[1]} THEN 'medium'
                WHEN churn_probability < {S.RISK_CUTS[2]} THEN 'high'
                ELSE 'critical' END AS risk_band,
           payment_errors, churned
    FROM scored
    """,
)
_fragment(
    "assume",
    (),
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{a}', '{p}', {r}::DOUBLE, {c}::DOUBLE)" for a, (p, r, c) in S.ACTIONS.items()
    )
    + ") AS t(recommended_action, intervention_priority, recovery_probability, intervention_cost)",
)
_fragment(
    "cand",
    ("score", "assume"),
    """
    SELECT d.*, intervention_priority FROM (
      SELECT user_id, session_id, observation_timestamp, churn_probability, churn_risk_score,
             risk_band, has_cart, reached_checkout, payment_errors,
             CASE WHEN risk_band NOT IN ('high', 'critical')
                    THEN CASE risk_band WHEN 'medium' THEN 'monitor' ELSE 'no_action' END
                  WHEN reached_checkout = 1
                    THEN CASE WHEN payment_errors > 0 THEN 'payment_recovery'
                              ELSE 'checkout_recovery' END
                  WHEN has_cart = 1 AND payment_errors = 0 THEN 'cart_recovery'
                  ELSE 'no_action' END AS recommended_action
      FROM score) AS d JOIN assume USING (recommended_action)
    """,
)
_fragment(
    "cart",
    ("ev",),
    "SELECT session_id, max(coalesce(cart_value, 0.0::DOUBLE)) AS cart_value FROM ev GROUP BY session_id",
)
_fragment(
    "econ",
    ("cand", "cart", "assume"),
    """
    SELECT v.*, v.expected_recovery_value - v.intervention_cost AS expected_net_value,
           greatest(v.expected_recovery_value - v.intervention_cost, 0.0::DOUBLE)
             AS business_priority_score
    FROM (SELECT user_id, session_id, observation_timestamp, recommended_action,
                 cand.intervention_priority, risk_band, churn_probability, churn_risk_score,
                 coalesce(cart.cart_value, 0.0::DOUBLE) AS cart_value,
                 recovery_probability, intervention_cost,
                 coalesce(cart.cart_value, 0.0::DOUBLE) * churn_probability
                   * recovery_probability AS expected_recovery_value
          FROM cand LEFT JOIN cart USING (session_id) JOIN assume USING (recommended_action)) AS v
    """,
)
_fragment(
    "port",
    ("econ",),
    f"""
    SELECT row_number() OVER (ORDER BY business_priority_score DESC, expected_net_value DESC,
             churn_risk_score DESC, session_id) AS portfolio_rank, *
    FROM econ WHERE recommended_action IN ({_list(S.RECOVERY_ACTIONS)})
    QUALIFY portfolio_rank <= {S.DEFAULT_CAPACITY}
    """,
)
_fragment(
    "roi",
    ("port",),
    """
    SELECT *, CASE WHEN intervention_cost > 0 THEN expected_net_value / intervention_cost * 100
                   ELSE 0.0::DOUBLE END AS roi_pct
    FROM port
    """,
)


def _statement(final: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _FRAGMENTS[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    chain = ",\n".join(f"{n} AS MATERIALIZED ({_FRAGMENTS[n][1]})" for n in order)
    return f"WITH {chain}\n{final.strip()}"


_SQL: dict[str, str] = {}


_FINAL: dict[str, str] = {}  # the last SELECT of each


def _sql(name: str, needs: str, final: str) -> None:
    _FINAL[name] = final
    _SQL[name] = _statement(final, *needs.split())


# --------------------------------------------------------------- scans, sinks
_sql(
    "scan_events",
    "ev",
    """
    SELECT event_id, user_id, session_id, event_timestamp, event_name,
           NULL::VARCHAR AS page, device_type, NULL::VARCHAR AS country, traffic_source,
           NULL::VARCHAR AS campaign, NULL::VARCHAR AS product_id, NULL::VARCHAR AS category,
           NULL::DOUBLE AS quantity, NULL::DOUBLE AS price, cart_value, experiment_id, variant,
           NULL::VARCHAR AS payment_method, NULL::VARCHAR AS error_code, persona,
           NULL::VARCHAR AS query, CAST(idle_seconds AS DOUBLE) AS idle_seconds
    FROM ev
    """,
)
_sql("load_events", "ev", "SELECT event_id, session_id, event_name, event_timestamp FROM ev")
_sql("write_table", "fun", "SELECT * FROM fun")
_sql("write_landing", "ev", "SELECT event_name, count(*) AS landed_rows FROM ev GROUP BY 1")

# --------------------------------------------------------------------- quality
_sql(
    "quality_report",
    "ev",
    f"""
    SELECT *, duplicate_event_ids + missing_required_values + invalid_event_names
              + invalid_variants + invalid_timestamps = 0 AS is_valid
    FROM (SELECT count(*) AS total_rows,
                 (SELECT count(*) FROM (SELECT event_id FROM ev GROUP BY 1 HAVING count(*) > 1))
                   AS duplicate_event_ids,
                 count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in S.REQUIRED_EVENT_COLUMNS)})
                   AS missing_required_values,
                 count(*) FILTER (event_name NOT IN ({_list(S.EVENT_NAMES)}))
                   AS invalid_event_names,
                 count(*) FILTER (variant NOT IN ({_list(S.VARIANTS)})) AS invalid_variants,
                 count(*) FILTER (event_timestamp IS NULL) AS invalid_timestamps
          FROM ev)
    """,
)
_sql(
    "dataset_overview",
    "ev",
    """
    SELECT count(*) AS total_events, count(DISTINCT user_id) AS total_users,
           count(DISTINCT session_id) AS total_sessions,
           min(event_timestamp) AS first_event, max(event_timestamp) AS last_event
    FROM ev
    """,
)
_sql("event_distribution", "ev", "SELECT event_name, count(*) AS event_count FROM ev GROUP BY 1")
_sql(
    "session_order_check",
    "ctx",
    """
    SELECT count(*) FILTER (event_timestamp < previous_event_timestamp) AS out_of_order_events
    FROM ctx
    """,
)
_sql(
    "missing_ids",
    "ev",
    """
    SELECT count(*) - count(user_id) AS missing_user_ids,
           count(*) - count(session_id) AS missing_session_ids
    FROM ev
    """,
)
_sql(
    "load_reconciliation",
    "ev",
    """
    SELECT count(*) AS landing_rows, count(*) AS warehouse_rows, CAST(0 AS BIGINT) AS row_difference
    FROM ev
    """,
)
_sql(
    "session_boundary",
    "ev",
    """
    SELECT count(*) FILTER (starts <> 1) AS invalid_session_starts,
           count(*) FILTER (ends <> 1) AS invalid_session_ends
    FROM (SELECT count(*) FILTER (event_name = 'session_start') AS starts,
                 count(*) FILTER (event_name = 'session_end') AS ends
          FROM ev GROUP BY session_id)
    """,
)
_sql(
    "unstable_assignment",
    "ev",
    """
    SELECT user_id, count(DISTINCT experiment_id) AS experiment_count,
           count(DISTINCT variant) AS variant_count
    FROM ev GROUP BY user_id HAVING NOT (experiment_count = 1 AND variant_count = 1)
    """,
)
_sql(
    "inconsistent_users",
    "ev",
    """
    SELECT count(*) FILTER (variants > 1) AS inconsistent_users
    FROM (SELECT count(DISTINCT variant) AS variants FROM ev
          WHERE experiment_id IS NOT NULL GROUP BY user_id)
    """,
)
_sql(
    "null_profile",
    "feat",
    "SELECT "
    + ", ".join(f"count(*) - count({c}) AS {c}" for c in S.FEATURE_TABLE_COLUMNS)
    + " FROM feat",
)

# ------------------------------------------------------------------- behavior
_sql("first_step_events", "firsts", "SELECT * FROM firsts")
_sql("session_funnel", "fun", "SELECT * FROM fun")
_sql(
    "funnel_metrics",
    "fun",
    """
    , counts AS (
      SELECT t.step_order, t.funnel_step, count(*) FILTER (t.hit) AS sessions
      FROM fun, LATERAL (VALUES (1, 'homepage_view', reached_homepage),
                                (2, 'product_click', reached_product_click),
                                (3, 'add_to_cart', reached_cart),
                                (4, 'purchase_complete', reached_purchase))
                AS t(step_order, funnel_step, hit)
      GROUP BY ALL)
    SELECT c.step_order, c.funnel_step, c.sessions,
           round(100.0 * c.sessions / nullif(e.sessions, 0), 2) AS absolute_conversion_pct,
           round(100.0 * c.sessions / nullif(p.sessions, 0), 2) AS step_conversion_pct,
           coalesce(p.sessions - c.sessions, 0) AS step_dropoff_sessions,
           CASE WHEN p.step_order IS NULL THEN 0.0::DOUBLE
                ELSE round(100.0 * (p.sessions - c.sessions) / nullif(p.sessions, 0), 2)
           END AS step_dropoff_pct
    FROM counts AS c JOIN counts AS e ON e.step_order = 1
         LEFT JOIN counts AS p ON p.step_order = c.step_order - 1
    """,
)
_sql(
    "funnel_outcomes",
    "fun",
    """
    SELECT funnel_outcome, count(*) AS sessions,
           round(100.0 * count(*) / (SELECT count(*) FROM fun), 2) AS percentage
    FROM fun GROUP BY 1
    """,
)
_sql(
    "funnel_ordering",
    "fun",
    """
    SELECT count(*) FILTER (product_click_at < homepage_view_at) AS invalid_product_click_order,
           count(*) FILTER (add_to_cart_at < product_click_at) AS invalid_cart_order,
           count(*) FILTER (purchase_complete_at < add_to_cart_at) AS invalid_purchase_order
    FROM fun
    """,
)
_sql(
    "purchase_consistency",
    "ev fun",
    """
    SELECT (SELECT count(*) FROM ev WHERE event_name = 'purchase_complete') AS raw_purchase_events,
           (SELECT count(*) FROM fun WHERE reached_purchase) AS funnel_purchase_sessions
    """,
)
_sql(
    "checkout_funnel",
    "ev",
    f"""
    , counts AS (
      SELECT list_position([{_list(S.CHECKOUT_FUNNEL_STEPS)}], event_name) AS step_order,
             event_name AS funnel_step, count(DISTINCT session_id) AS sessions
      FROM ev WHERE event_name IN ({_list(S.CHECKOUT_FUNNEL_STEPS)}) GROUP BY ALL)
    SELECT CAST(c.step_order AS INTEGER) AS step_order, c.funnel_step, c.sessions,
           round(100.0 * c.sessions / e.sessions, 2) AS conversion_from_product_pct
    FROM counts AS c JOIN counts AS e ON e.step_order = 1
    """,
)
_sql("event_context", "ctx", "SELECT * FROM ctx")
_sql("event_velocity", "gaps", "SELECT * FROM gaps")
_sql("velocity_metrics", "vel", "SELECT * FROM vel")
_VELOCITY_MEANS = f"""count(*) AS sessions,
           {_mean('session_duration_minutes')} AS avg_session_duration_minutes,
           {_mean('average_event_gap_minutes')} AS avg_event_gap_minutes,
           {_mean('maximum_event_gap_minutes')} AS avg_max_event_gap_minutes,
           {_mean('total_events')} AS avg_events_per_session"""
_sql("velocity_overview", "vel", f"SELECT {_VELOCITY_MEANS} FROM vel")
_sql(
    "outcome_velocity",
    "fun vel",
    f"""
    SELECT funnel_outcome, {_VELOCITY_MEANS}
    FROM fun JOIN vel USING (session_id, user_id)
    WHERE funnel_outcome IN ('purchased', 'cart_abandoned') GROUP BY 1
    """,
)
_sql(
    "cart_idle_events",
    "ev",
    """
    SELECT s.persona, count(*) AS cart_view_events,
           round(avg(v.idle_seconds), 2) AS avg_idle_seconds,
           CAST(max(v.idle_seconds) AS DOUBLE) AS max_idle_seconds
    FROM ev AS v JOIN ev AS s USING (session_id, user_id)
    WHERE v.event_name = 'cart_view' AND v.idle_seconds IS NOT NULL
      AND s.event_name = 'session_start'
    GROUP BY 1
    """,
)
_sql(
    "cart_idle_sessions",
    "ev",
    """
    SELECT persona, round(avg(idle), 2) AS average_cart_idle_seconds,
           CAST(max(idle) AS DOUBLE) AS maximum_cart_idle_seconds
    FROM (SELECT max(persona) AS persona, max(idle_seconds) AS idle FROM ev GROUP BY session_id)
    WHERE idle IS NOT NULL GROUP BY 1
    """,
)
_sql(
    "persona_distribution",
    "ev",
    """
    SELECT persona, count(DISTINCT user_id) AS users, count(*) AS sessions
    FROM ev WHERE event_name = 'session_start' GROUP BY 1
    """,
)
_sql(
    "payment_friction",
    "ev",
    """
    SELECT variant, count(*) FILTER (event_name = 'payment_attempt') AS payment_attempts,
           count(*) FILTER (event_name = 'payment_error') AS payment_errors,
           round(100.0 * count(*) FILTER (event_name = 'payment_error')
             / nullif(count(*) FILTER (event_name = 'payment_attempt'), 0), 3)
             AS payment_error_rate_pct
    FROM ev GROUP BY 1
    """,
)
_sql("session_preview", "fun", "SELECT * FROM fun ORDER BY session_id, user_id LIMIT 100")
_sql(
    "session_histogram",
    "vel",
    """
    , bounds AS (SELECT min(session_duration_minutes) AS low,
                        (max(session_duration_minutes) - min(session_duration_minutes)) / 30 AS w
                 FROM vel)
    SELECT b AS bin, round(low + b * w, 6) AS bin_start, round(low + (b + 1) * w, 6) AS bin_end,
           count(*) AS sessions
    FROM (SELECT CAST(least(29, floor((session_duration_minutes - low) / w)) AS INTEGER) AS b, low, w
          FROM vel, bounds WHERE session_duration_minutes IS NOT NULL)
    GROUP BY b, low, w
    """,
)

# ----------------------------------------------------------------- experiments
_sql("assign_variant", "ev", "SELECT DISTINCT user_id, experiment_id, variant FROM ev")
_sql("experiment_population", "pop", "SELECT * FROM pop")
_SUMMARY = """
    SELECT variant, count(*) AS users, count(*) FILTER (converted) AS conversions,
           round(100.0 * count(*) FILTER (converted) / count(*), 2) AS conversion_rate_pct
    FROM {} GROUP BY 1"""
_sql("experiment_summary", "pop", _SUMMARY.format("pop"))
_sql(
    "displayed_lift",
    "spop",
    f"""
    , s AS ({_SUMMARY.format('spop')})
    SELECT round(t.conversion_rate_pct - c.conversion_rate_pct, 6) AS absolute_lift,
           round(CASE WHEN c.conversion_rate_pct > 0
             THEN (t.conversion_rate_pct - c.conversion_rate_pct) / c.conversion_rate_pct * 100
             ELSE 0 END, 6) AS relative_lift
    FROM s AS c, s AS t WHERE c.variant = 'control' AND t.variant = 'treatment'
    """,
)
_sql(
    "variant_share",
    "ev",
    """
    SELECT variant, count(DISTINCT user_id) AS users,
           round(100.0 * count(DISTINCT user_id)
             / (SELECT sum(u) FROM (SELECT count(DISTINCT user_id) AS u FROM ev GROUP BY variant)),
             2) AS user_percentage
    FROM ev GROUP BY 1
    """,
)
_sql(
    "session_ab",
    "spop",
    """
    , s AS (SELECT variant, count(*) AS sessions, count(*) FILTER (converted) AS conversions,
                   round(100.0 * count(*) FILTER (converted) / count(*), 3) AS conversion_rate_pct
            FROM spop GROUP BY 1)
    SELECT s.*, round(t.conversion_rate_pct - c.conversion_rate_pct, 6) AS absolute_lift,
           round(CASE WHEN c.conversion_rate_pct > 0
             THEN (t.conversion_rate_pct / c.conversion_rate_pct - 1) * 100 ELSE 0 END, 6)
             AS relative_lift_pct
    FROM s, s AS c, s AS t WHERE c.variant = 'control' AND t.variant = 'treatment'
    """,
)
_sql(
    "population_integrity",
    "pop",
    """
    SELECT count(*) AS total_rows, count(DISTINCT user_id) AS distinct_users,
           count(*) - count(DISTINCT user_id) AS duplicate_users
    FROM pop
    """,
)
_sql(
    "population_reconciliation",
    "ev pop",
    """
    SELECT a.n AS experiment_assigned_users, b.n AS eligible_population_users,
           b.n <= a.n AS is_consistent
    FROM (SELECT count(DISTINCT user_id) AS n FROM ev WHERE experiment_id IS NOT NULL) AS a,
         (SELECT count(*) AS n FROM pop) AS b
    """,
)
_sql(
    "conversion_overflow",
    "pop",
    """
    SELECT variant, count(*) AS users, count(*) FILTER (converted) AS conversions
    FROM pop GROUP BY 1 HAVING conversions > users
    """,
)
_sql(
    "ab_test",
    "spop",
    f"""
    , n AS (SELECT count(*) FILTER (variant = 'control') AS nc,
                   count(*) FILTER (variant = 'treatment') AS nt,
                   count(*) FILTER (variant = 'control' AND converted) AS xc,
                   count(*) FILTER (variant = 'treatment' AND converted) AS xt
            FROM spop),
    r AS (SELECT *, xc / nc AS rc, xt / nt AS rt, (xc + xt) / (nc + nt) AS pooled,
                 {critical_value(0.95)!r}::DOUBLE * sqrt(
                   xc / nc * (1 - xc / nc) / nc + xt / nt * (1 - xt / nt) / nt) AS half
          FROM n),
    cells AS (
      SELECT sum((observed - expected) ** 2 / expected) AS chi
      FROM r, LATERAL (VALUES (xc::DOUBLE, nc * pooled), (nc - xc, nc * (1 - pooled)),
                              (xt, nt * pooled), (nt - xt, nt * (1 - pooled)))
              AS t(observed, expected))
    SELECT nc AS control_users, nt AS treatment_users, xc AS control_conversions,
           xt AS treatment_conversions, round(rc, 6) AS control_conversion_rate,
           round(rt, 6) AS treatment_conversion_rate, round(rt - rc, 6) AS absolute_lift,
           round((rt - rc) / rc, 6) AS relative_lift,
           round((rt - rc) / sqrt(pooled * (1 - pooled) * (1 / nc + 1 / nt)), 6) AS z_statistic,
           round(chi, 6) AS chi_square_statistic,
           round(rt - rc - half, 6) AS confidence_interval_lower,
           round(rt - rc + half, 6) AS confidence_interval_upper
    FROM r, cells
    """,
)

_sql(
    "ab_inference",
    "spop",
    f"""
    , n AS (SELECT count(*) FILTER (variant = 'control') AS nc,
                   count(*) FILTER (variant = 'treatment') AS nt,
                   count(*) FILTER (variant = 'control' AND converted) AS xc,
                   count(*) FILTER (variant = 'treatment' AND converted) AS xt
            FROM spop),
    r AS (SELECT *, xc / nc AS rc, xt / nt AS rt, (xc + xt) / (nc + nt) AS pooled,
                 (xt / nt - xc / nc) / sqrt((xc + xt) / (nc + nt) * (1 - (xc + xt) / (nc + nt))
                   * (1 / nc + 1 / nt)) AS z,
                 {critical_value(0.95)!r}::DOUBLE * sqrt(
                   xc / nc * (1 - xc / nc) / nc + xt / nt * (1 - xt / nt) / nt) AS half
          FROM n),
    -- P(|Z| < z) by its power series: 2 phi(z) (z + z^3/3 + z^5/(3*5) + ...)
    series AS (SELECT i, sum(ln(2 * i + 1)) OVER (ORDER BY i) AS ln_odd FROM range(150) AS t(i)),
    inside AS (SELECT 2 * exp(-any_value(z * z) / 2) / sqrt(2 * pi())
                        * sum(abs(z) * exp(i * ln(z * z) - ln_odd)) AS p
               FROM r, series)
    SELECT nc AS control_users, nt AS treatment_users, xc AS control_conversions,
           xt AS treatment_conversions, round(rc, 6) AS control_conversion_rate,
           round(rt, 6) AS treatment_conversion_rate, round(rt - rc, 6) AS absolute_lift,
           round((rt - rc) / rc, 6) AS relative_lift, round(z, 6) AS z_statistic,
           round(1 - p, 6) AS z_test_p_value, round(z * z, 6) AS chi_square_statistic,
           round(1 - p, 6) AS chi_square_p_value,
           round(rt - rc - half, 6) AS confidence_interval_lower,
           round(rt - rc + half, 6) AS confidence_interval_upper,
           1 - p < 0.05 AS statistically_significant,
           CASE WHEN 1 - p >= 0.05 OR z = 0
                  THEN 'No statistically significant evidence of improvement. Continue experiment.'
                WHEN z > 0 THEN 'Treatment outperforms Control. Recommend rollout.'
                ELSE 'Treatment underperforms Control. Do not roll out.' END AS recommendation
    FROM r, inside
    """,
)
_sql(
    "ab_consistency",
    "spop",
    f"""
    , r AS (SELECT avg(CAST(converted AS INTEGER)) FILTER (variant = 'control') AS rc,
                   avg(CAST(converted AS INTEGER)) FILTER (variant = 'treatment') AS rt,
                   count(*) FILTER (variant = 'control') AS nc,
                   count(*) FILTER (variant = 'treatment') AS nt,
                   avg(CAST(converted AS INTEGER)) AS pooled FROM spop),
    c AS (SELECT abs(rt - rc) > {critical_value(0.95)!r}::DOUBLE
                   * sqrt(pooled * (1 - pooled) * (1 / nc + 1 / nt)) AS statistically_significant,
                 abs(rt - rc) <= {critical_value(0.95)!r}::DOUBLE
                   * sqrt(rc * (1 - rc) / nc + rt * (1 - rt) / nt) AS interval_contains_zero
          FROM r)
    SELECT *, statistically_significant <> interval_contains_zero AS is_consistent FROM c
    """,
)

# -------------------------------------------------------------------- features
_sql(
    "ordered_events",
    "ev",
    """
    SELECT event_id, user_id, session_id, event_timestamp, event_name, NULL::VARCHAR AS page,
           device_type, traffic_source, NULL::VARCHAR AS category, NULL::DOUBLE AS quantity,
           NULL::DOUBLE AS price, cart_value, persona,
           row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id)
             AS event_sequence,
           count(*) OVER (PARTITION BY session_id) AS total_session_events
    FROM ev
    """,
)
_sql("session_outcomes", "outcome", "SELECT * FROM outcome")
_sql(
    "observation_events",
    "obs",
    """
    SELECT session_id, user_id, event_id, event_name, event_timestamp, purchase_timestamp FROM obs
    """,
)
_sql("observation_cutoff", "cut", "SELECT * FROM cut")
_sql("churn_features", "feat", "SELECT * FROM feat")
_sql(
    "churn_summary",
    "feat",
    """
    SELECT count(*) AS total_sessions, count(DISTINCT user_id) AS total_users,
           CAST(sum(churned) AS BIGINT) AS churned_sessions,
           CAST(sum(1 - churned) AS BIGINT) AS converted_sessions,
           round(100.0 * sum(churned) / count(churned), 2) AS churn_rate_pct
    FROM feat
    """,
)
_sql(
    "churn_distribution",
    "feat",
    """
    SELECT churned, count(*) AS sessions,
           round(100.0 * count(*) / (SELECT count(*) FROM feat), 2) AS percentage
    FROM feat GROUP BY 1
    """,
)
_sql(
    "feature_summary",
    "feat",
    """
    SELECT round(avg(total_actions_so_far), 2) AS avg_total_actions,
           min(total_actions_so_far) AS min_total_actions,
           max(total_actions_so_far) AS max_total_actions,
           round(avg(unique_event_types), 2) AS avg_unique_event_types,
           round(avg(product_views), 2) AS avg_product_views,
           round(avg(add_to_cart_actions), 2) AS avg_add_to_cart_actions,
           round(avg(cart_views), 2) AS avg_cart_views,
           round(avg(checkout_starts), 2) AS avg_checkout_starts,
           round(avg(payment_attempts), 2) AS avg_payment_attempts,
           round(avg(payment_errors), 2) AS avg_payment_errors,
           round(avg(observed_session_duration_minutes), 2) AS avg_observed_duration_minutes
    FROM feat
    """,
)
_sql(
    "feature_categories",
    "feat",
    "SELECT device_type, traffic_source, count(*) AS sessions FROM feat GROUP BY ALL",
)
_CORRELATIONS = "\nUNION ALL\n".join(
    f"SELECT {i} AS ia, {j} AS ib, '{a}' AS feature_a, '{b}' AS feature_b, "
    f"corr({a}, {b}) AS correlation FROM feat"
    for i, a in enumerate(S.NUMERIC_FEATURES)
    for j, b in enumerate(S.NUMERIC_FEATURES)
)
_sql(
    "feature_correlations",
    "feat",
    f"""
    SELECT feature_a, feature_b, round(correlation, 6) AS correlation
    FROM ({_CORRELATIONS})
    """,
)
_sql(
    "high_correlations",
    "feat",
    f"""
    SELECT feature_a, feature_b, round(correlation, 6) AS correlation,
           round(abs(correlation), 6) AS absolute_correlation
    FROM ({_CORRELATIONS})
    WHERE ia < ib AND abs(correlation) >= {S.CORRELATION_CUT} AND NOT isnan(correlation)
    """,
)
_sql(
    "ml_integrity",
    "feat",
    """
    SELECT *, duplicate_sessions = 0 AND invalid_labels = 0 AND inconsistent_labels = 0 AS passed
    FROM (SELECT count(*) AS total_rows, count(DISTINCT session_id) AS distinct_sessions,
                 count(*) FILTER (churned IS NULL OR churned NOT IN (0, 1)) AS invalid_labels,
                 count(*) FILTER (purchased = churned) AS inconsistent_labels,
                 count(*) - count(DISTINCT session_id) AS duplicate_sessions
          FROM feat)
    """,
)
for _name, _column in (("churn_by_device", "device_type"), ("churn_by_source", "traffic_source")):
    _sql(
        _name,
        "feat",
        f"""
        SELECT {_column}, count(*) AS sessions, round(avg(churned) * 100, 2) AS churn_rate_pct
        FROM feat GROUP BY 1
        """,
    )

# ---------------------------------------------------------------- diagnostics
_CELLS = """
    , cells AS (SELECT count(*) FILTER (hit AND churned = 1) AS tp,
                       count(*) FILTER (hit AND churned = 0) AS fp,
                       count(*) FILTER (NOT hit AND churned = 1) AS fn,
                       count(*) FILTER (NOT hit AND churned = 0) AS tn
                FROM (SELECT churned, churn_probability {} AS hit FROM scored))"""
_sql(
    "classification_metrics",
    "scored",
    _CELLS.format("> 0.5")
    + """
    SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
           round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score
    FROM cells
    """,
)
_sql(
    "classification_report",
    "scored",
    _CELLS.format("> 0.5")
    + """
    , k AS (
      SELECT t.*, tp + fp + fn + tn AS total, (tp + tn) / (tp + fp + fn + tn) AS accuracy
      FROM cells, LATERAL (VALUES
             ('0', tn / nullif(tn + fn, 0), tn / nullif(tn + fp, 0),
              2 * tn / nullif(2 * tn + fn + fp, 0), tn + fp),
             ('1', tp / nullif(tp + fp, 0), tp / nullif(tp + fn, 0),
              2 * tp / nullif(2 * tp + fp + fn, 0), tp + fn)) AS t(label, p, r, f, support)),
    lines AS (
      SELECT CAST(label AS INTEGER) + 1 AS line, label, p, r, f, support FROM k
      UNION ALL SELECT 3, 'accuracy', any_value(accuracy), any_value(accuracy),
                       any_value(accuracy), CAST(sum(support) AS BIGINT) FROM k
      UNION ALL SELECT 4, 'macro avg', avg(coalesce(p, 0)), avg(coalesce(r, 0)),
                       avg(coalesce(f, 0)), CAST(sum(support) AS BIGINT) FROM k
      UNION ALL SELECT 5, 'weighted avg', sum(coalesce(p, 0) * support) / sum(support),
                       sum(coalesce(r, 0) * support) / sum(support),
                       sum(coalesce(f, 0) * support) / sum(support),
                       CAST(sum(support) AS BIGINT) FROM k)
    SELECT line, label, round(coalesce(p, 0), 6) AS precision, round(coalesce(r, 0), 6) AS recall,
           round(coalesce(f, 0), 6) AS f1_score, support
    FROM lines
    """,
)
_sql(
    "roc_auc",
    "scored",
    """
    , ranked AS (
      SELECT churned, rank() OVER (ORDER BY churn_probability)
               + (count(*) OVER (PARTITION BY churn_probability) - 1) / 2 AS mid
      FROM scored)
    SELECT round((sum(mid) FILTER (churned = 1)
                  - sum(churned) * (sum(churned) + 1) / 2)
                 / (sum(churned) * sum(1 - churned)), 6) AS roc_auc
    FROM ranked
    """,
)
_sql(
    "threshold_sweep",
    "scored",
    f"""
    , t AS (SELECT CAST(unnest([{', '.join(str(t) for t in S.THRESHOLDS)}]) AS DOUBLE) AS threshold),
    c AS (SELECT threshold, count(*) AS n,
                 count(*) FILTER (churn_probability >= threshold) AS flagged,
                 count(*) FILTER (churn_probability >= threshold AND churned = 1) AS hits,
                 count(*) FILTER ((churn_probability >= threshold) = (churned = 1)) AS agree,
                 count(*) FILTER (churned = 1) AS positives
          FROM t, scored GROUP BY 1)
    SELECT threshold, flagged AS flagged_sessions, round(100.0 * flagged / n, 6) AS flagged_percentage,
           round(agree / n, 6) AS accuracy,
           round(coalesce(hits / nullif(flagged, 0), 0), 6) AS precision,
           round(coalesce(hits / nullif(positives, 0), 0), 6) AS recall
    FROM c
    """,
)
_sql(
    "high_risk_summary",
    "scored",
    _CELLS.format(f">= {S.HIGH_RISK_THRESHOLD}")
    + f"""
    SELECT {S.HIGH_RISK_THRESHOLD}::DOUBLE AS threshold, tp + fp AS flagged_sessions,
           round(100.0 * (tp + fp) / (tp + fp + fn + tn), 6) AS flagged_percentage,
           tp AS true_abandonments, fp AS false_positives,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
           round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall
    FROM cells
    """,
)
_sql(
    "brier_score",
    "scored",
    "SELECT round(avg((churn_probability - churned) ** 2), 6) AS brier_score FROM scored",
)
_BINS = """
    , edges AS (SELECT CAST(i AS INTEGER) AS bin, i * 0.1::DOUBLE AS lo,
                       CASE i WHEN 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS hi
                FROM range(10) AS t(i)),
    binned AS (SELECT bin, lo, hi, count(churned) AS sessions,
                      round(avg(churn_probability) * 100, 6) AS average_predicted_probability_pct,
                      round(avg(churned) * 100, 6) AS actual_churn_rate_pct,
                      round(avg(churned) * 100 - avg(churn_probability) * 100, 6)
                        AS calibration_gap_pct
               FROM edges LEFT JOIN scored
                 ON churn_probability <= hi
                    AND (churn_probability > lo OR (bin = 0 AND churn_probability = 0))
               GROUP BY bin, lo, hi)"""
_sql(
    "calibration_table",
    "scored",
    _BINS
    + """
    SELECT bin, round(lo, 6) AS bin_lower, round(hi, 6) AS bin_upper, sessions,
           average_predicted_probability_pct, actual_churn_rate_pct, calibration_gap_pct
    FROM binned
    """,
)
_sql(
    "calibration_curve",
    "scored",
    _BINS
    + """
    SELECT bin, average_predicted_probability_pct, actual_churn_rate_pct
    FROM binned WHERE sessions > 0
    """,
)
_sql(
    "probability_summary",
    "scored",
    "SELECT count(churn_probability) AS count, round(avg(churn_probability), 6) AS mean, "
    "round(stddev_samp(churn_probability), 6) AS std, min(churn_probability) AS min, "
    "max(churn_probability) AS max, "
    + ", ".join(
        f"round(quantile_cont(churn_probability, {q}), 6) AS p{round(q * 100):02d}"
        for q in S.SUMMARY_PERCENTILES
    )
    + " FROM scored",
)

# ------------------------------------------------------------------ risk bands
_sql(
    "risk_bands",
    "score",
    """
    SELECT user_id, session_id, observation_timestamp, has_cart, reached_checkout, purchased,
           churn_probability, round(churn_risk_score, 6) AS churn_risk_score, risk_band
    FROM score
    """,
)
_sql(
    "risk_distribution",
    "score",
    """
    SELECT risk_band, count(*) AS sessions,
           round(100.0 * count(*) / (SELECT count(*) FROM score), 2) AS percentage
    FROM score GROUP BY 1
    """,
)
_sql(
    "top_risk_sessions",
    "score",
    """
    SELECT session_id, round(churn_risk_score, 6) AS churn_risk_score, risk_band
    FROM score ORDER BY score.churn_risk_score DESC, session_id LIMIT 50
    """,
)
_sql(
    "risk_totals",
    "score",
    """
    SELECT count(*) AS scored_sessions, count(*) FILTER (risk_band = 'critical') AS critical_sessions,
           round(avg(churn_risk_score), 6) AS average_risk_score
    FROM score
    """,
)
_sql(
    "risk_histogram",
    "score",
    """
    SELECT b AS bin, round(b * 2.5::DOUBLE, 6) AS bin_start, round((b + 1) * 2.5::DOUBLE, 6) AS bin_end,
           count(*) AS sessions
    FROM (SELECT CAST(least(39, floor(churn_risk_score / 2.5::DOUBLE)) AS INTEGER) AS b FROM score)
    GROUP BY b
    """,
)

# --------------------------------------------------------------- interventions
_sql(
    "intervention_candidates",
    "cand",
    """
    SELECT user_id, session_id, observation_timestamp, churn_probability,
           round(churn_risk_score, 6) AS churn_risk_score, risk_band, has_cart, reached_checkout,
           payment_errors, recommended_action, intervention_priority
    FROM cand
    """,
)
_sql("action_distribution", "cand", "SELECT recommended_action, count(*) AS sessions FROM cand GROUP BY 1")
_sql(
    "priority_distribution",
    "cand",
    "SELECT intervention_priority, count(*) AS sessions FROM cand GROUP BY 1",
)
_sql("session_cart_value", "cart", "SELECT * FROM cart")
_ECONOMICS = """user_id, session_id, observation_timestamp, recommended_action,
           intervention_priority, risk_band, churn_probability,
           round(churn_risk_score, 6) AS churn_risk_score, cart_value, recovery_probability,
           intervention_cost, round(expected_recovery_value, 6) AS expected_recovery_value,
           round(expected_net_value, 6) AS expected_net_value,
           round(business_priority_score, 6) AS business_priority_score"""
_sql("intervention_economics", "econ", f"SELECT {_ECONOMICS} FROM econ")
_sql(
    "economics_by_action",
    "econ",
    """
    SELECT recommended_action, count(*) AS sessions, round(avg(cart_value), 2) AS avg_cart_value,
           round(sum(expected_recovery_value), 2) AS total_expected_recovery_value,
           round(sum(intervention_cost), 2) AS total_intervention_cost,
           round(sum(expected_net_value), 2) AS total_expected_net_value
    FROM econ GROUP BY 1
    """,
)
_sql(
    "top_opportunities",
    "econ",
    """
    SELECT session_id, recommended_action, round(churn_risk_score, 6) AS churn_risk_score,
           cart_value, round(expected_net_value, 6) AS expected_net_value,
           round(econ.business_priority_score, 6) AS business_priority_score
    FROM econ ORDER BY econ.business_priority_score DESC, session_id LIMIT 10
    """,
)
_sql("intervention_portfolio", "port", f"SELECT portfolio_rank, {_ECONOMICS} FROM port")
_sql(
    "portfolio_by_action",
    "port",
    """
    SELECT recommended_action, count(*) AS sessions,
           round(sum(expected_net_value), 2) AS expected_net_value
    FROM port GROUP BY 1
    """,
)
_sql(
    "portfolio_totals",
    "port",
    """
    SELECT count(*) AS selected_sessions,
           round(sum(expected_net_value), 2) AS total_expected_net_value,
           round(avg(expected_net_value), 2) AS average_expected_net_value
    FROM port
    """,
)
_sql(
    "intervention_roi",
    "roi",
    f"SELECT portfolio_rank, {_ECONOMICS}, round(roi_pct, 6) AS roi_pct FROM roi",
)
_SUMS = """round(sum(expected_recovery_value), 4) AS expected_recovery_value,
           round(sum(intervention_cost), 4) AS intervention_cost,
           round(sum(expected_net_value), 4) AS expected_net_value"""
_RATIO = """round(CASE WHEN sum(intervention_cost) > 0
             THEN sum(expected_net_value) / sum(intervention_cost) * 100 ELSE 0 END, 4)"""
_sql("roi_totals", "roi", f"SELECT {_SUMS}, {_RATIO} AS overall_roi_pct FROM roi")
_sql(
    "roi_by_action",
    "roi",
    f"""
    SELECT recommended_action, count(*) AS sessions, {_SUMS}, {_RATIO} AS roi_pct
    FROM roi GROUP BY 1
    """,
)
_sql(
    "top_roi",
    "roi",
    """
    SELECT portfolio_rank, session_id, recommended_action, cart_value,
           round(expected_recovery_value, 6) AS expected_recovery_value, intervention_cost,
           round(expected_net_value, 6) AS expected_net_value, round(roi_pct, 6) AS roi_pct
    FROM roi ORDER BY roi.roi_pct DESC, portfolio_rank LIMIT 10
    """,
)
_sql(
    "portfolio_value_by_action",
    "roi",
    f"SELECT recommended_action, count(*) AS sessions, {_SUMS} FROM roi GROUP BY 1",
)
_sql(
    "action_roi_summary",
    "roi",
    f"""
    SELECT recommended_action, count(*) AS sessions, {_SUMS},
           round(avg(roi_pct), 4) AS average_roi_pct
    FROM roi GROUP BY 1
    """,
)
_sql(
    "portfolio_summary",
    "roi",
    f"""
    SELECT count(*) AS selected_sessions, round(sum(expected_net_value), 4) AS total_expected_net_value,
           round(avg(expected_net_value), 4) AS average_expected_net_value,
           round(sum(expected_recovery_value), 4) AS total_expected_recovery_value,
           round(sum(intervention_cost), 4) AS total_intervention_cost,
           {_RATIO} AS portfolio_roi_pct
    FROM roi
    """,
)
_sql(
    "top_interventions",
    "roi",
    """
    SELECT portfolio_rank, session_id, recommended_action,
           round(churn_risk_score, 2) AS churn_risk_score, round(cart_value, 2) AS cart_value,
           round(expected_recovery_value, 2) AS expected_recovery_value,
           round(intervention_cost, 2) AS intervention_cost,
           round(expected_net_value, 2) AS expected_net_value, round(roi_pct, 2) AS roi_pct
    FROM roi WHERE portfolio_rank <= 25
    """,
)

# ------------------------------------------------------------------- contracts
_sql(
    "session_reconciliation",
    "feat score",
    """
    SELECT (SELECT count(*) FROM feat ANTI JOIN score USING (session_id))
             AS feature_sessions_missing_scores,
           (SELECT count(*) FROM score ANTI JOIN feat USING (session_id))
             AS unexpected_scored_sessions
    """,
)
_sql(
    "score_contract",
    "feat score",
    f"""
    SELECT *, feature_dataset_rows = scored_rows AND scored_rows = distinct_scored_sessions
              AND duplicate_sessions + feature_sessions_missing_scores
                  + unexpected_scored_sessions + missing_scores + out_of_range_scores
                  + invalid_risk_bands = 0 AS passed
    FROM (SELECT (SELECT count(*) FROM feat) AS feature_dataset_rows,
                 count(*) AS scored_rows, count(DISTINCT session_id) AS distinct_scored_sessions,
                 (SELECT count(*) FROM (SELECT session_id FROM score GROUP BY 1 HAVING count(*) > 1))
                   AS duplicate_sessions,
                 (SELECT count(*) FROM feat ANTI JOIN score USING (session_id))
                   AS feature_sessions_missing_scores,
                 (SELECT count(*) FROM score ANTI JOIN feat USING (session_id))
                   AS unexpected_scored_sessions,
                 count(*) FILTER (churn_probability IS NULL OR churn_risk_score IS NULL
                                  OR risk_band IS NULL) AS missing_scores,
                 round(min(churn_risk_score), 6) AS minimum_risk_score,
                 round(max(churn_risk_score), 6) AS maximum_risk_score,
                 count(*) FILTER (churn_risk_score NOT BETWEEN 0 AND 100) AS out_of_range_scores,
                 count(*) FILTER (risk_band NOT IN ({_list(S.RISK_BANDS)})) AS invalid_risk_bands
          FROM score)
    """,
)
_sql(
    "candidate_contract",
    "score cand assume",
    f"""
    SELECT *, scored_sessions = intervention_sessions
              AND intervention_sessions = distinct_intervention_sessions
              AND duplicate_sessions + missing_interventions + unexpected_interventions
                  + missing_values + invalid_actions + invalid_priorities
                  + inconsistent_actions = 0 AS passed
    FROM (SELECT (SELECT count(*) FROM score) AS scored_sessions,
                 count(*) AS intervention_sessions,
                 count(DISTINCT session_id) AS distinct_intervention_sessions,
                 (SELECT count(*) FROM (SELECT session_id FROM cand GROUP BY 1 HAVING count(*) > 1))
                   AS duplicate_sessions,
                 (SELECT count(*) FROM score ANTI JOIN cand USING (session_id))
                   AS missing_interventions,
                 (SELECT count(*) FROM cand ANTI JOIN score USING (session_id))
                   AS unexpected_interventions,
                 count(*) FILTER (recommended_action IS NULL OR c.intervention_priority IS NULL)
                   AS missing_values,
                 count(*) FILTER (recommended_action NOT IN ({_list(S.ACTIONS)}))
                   AS invalid_actions,
                 count(*) FILTER (c.intervention_priority NOT IN ({_list(S.PRIORITIES)}))
                   AS invalid_priorities,
                 count(*) FILTER (c.intervention_priority <> a.intervention_priority)
                   AS inconsistent_actions
          FROM cand AS c LEFT JOIN assume AS a USING (recommended_action))
    """,
)
_sql(
    "roi_contract",
    "port roi",
    """
    SELECT *, totals_match AND row_difference = 0
              AND duplicate_sessions + missing_from_roi + unexpected_roi_sessions + missing_values
                  + negative_recovery_values + negative_costs + invalid_net_value_rows
                  + invalid_zero_cost_roi_rows + invalid_roi_rows = 0 AS passed
    FROM (SELECT (SELECT count(*) FROM port) AS portfolio_rows, count(*) AS roi_rows,
                 count(*) - (SELECT count(*) FROM port) AS row_difference,
                 (SELECT count(*) FROM (SELECT session_id FROM roi GROUP BY 1 HAVING count(*) > 1))
                   AS duplicate_sessions,
                 (SELECT count(*) FROM port ANTI JOIN roi USING (session_id)) AS missing_from_roi,
                 (SELECT count(*) FROM roi ANTI JOIN port USING (session_id))
                   AS unexpected_roi_sessions,
                 4 * count(*) - count(expected_recovery_value) - count(intervention_cost)
                   - count(expected_net_value) - count(roi_pct) AS missing_values,
                 count(*) FILTER (expected_recovery_value < 0) AS negative_recovery_values,
                 count(*) FILTER (intervention_cost < 0) AS negative_costs,
                 count(*) FILTER (abs(expected_recovery_value - intervention_cost
                                      - expected_net_value) > 1e-6) AS invalid_net_value_rows,
                 count(*) FILTER (intervention_cost = 0 AND abs(roi_pct) > 1e-6)
                   AS invalid_zero_cost_roi_rows,
                 count(*) FILTER (intervention_cost > 0 AND
                   abs(expected_net_value / intervention_cost * 100 - roi_pct) > 1e-6)
                   AS invalid_roi_rows,
                 abs(sum(expected_recovery_value) - sum(intervention_cost)
                     - sum(expected_net_value)) <= 1e-6 * greatest(1, sum(expected_recovery_value))
                   AS totals_match
          FROM roi)
    """,
)
_TABLE_OF = {
    "features": "feat",
    "scores": "score",
    "candidates": "cand",
    "economics": "econ",
    "portfolio": "port",
    "roi": "roi",
}
_PAIRS = (
    ("features", "scores"),
    ("scores", "features"),
    ("candidates", "scores"),
    ("candidates", "economics"),
    ("portfolio", "economics"),
    ("portfolio", "roi"),
    ("roi", "portfolio"),
)
_sql(
    "warehouse_contract",
    "feat score cand econ port roi",
    ", c AS (SELECT "
    + ", ".join(
        [f"(SELECT count(*) FROM {t}) AS {n}_sessions" for n, t in _TABLE_OF.items()]
        + [
            f"(SELECT count(*) FROM (SELECT session_id FROM {t} GROUP BY 1 HAVING count(*) > 1))"
            f" AS duplicate_{n}_sessions"
            for n, t in _TABLE_OF.items()
        ]
        + [
            f"(SELECT count(*) FROM {_TABLE_OF[a]} ANTI JOIN {_TABLE_OF[b]} USING (session_id))"
            f" AS {a}_missing_{b}"
            for a, b in _PAIRS
        ]
        + [
            "(SELECT count(*) FROM cand WHERE coalesce(trim(recommended_action), '') = '')"
            " AS missing_recommended_actions"
        ]
    )
    + f"""),
    d AS (SELECT *, portfolio_sessions <= {S.DEFAULT_CAPACITY} AS capacity_respected,
                 features_sessions = scores_sessions AND scores_sessions = candidates_sessions
                 AND candidates_sessions = economics_sessions AND portfolio_sessions = roi_sessions
                 AND portfolio_sessions <= economics_sessions AS counts_chain
          FROM c)
    SELECT *, capacity_respected AND counts_chain AND features_sessions > 0 AND """
    + " + ".join(
        [f"duplicate_{n}_sessions" for n in _TABLE_OF]
        + [f"{a}_missing_{b}" for a, b in _PAIRS]
        + ["missing_recommended_actions"]
    )
    + " = 0 AS passed FROM d",
)
_sql(
    "executive_kpis",
    "feat port roi",
    """
    SELECT f.*, (SELECT count(*) FROM port) AS portfolio_sessions, r.*
    FROM (SELECT count(DISTINCT session_id) AS total_sessions,
                 count(DISTINCT user_id) AS total_users,
                 round(avg(churned) * 100, 4) AS churn_rate_pct FROM feat) AS f,
         (SELECT """
    + _SUMS
    + """ FROM roi) AS r
    """,
)


# ------------------------------------------------------------------- streaming
_sql("incremental_load", "ev", "SELECT event_name, count(*) AS loaded_rows FROM ev GROUP BY 1")
_sql(
    "gated_stream",
    "ev",
    """
    SELECT side, event_name, count(*) AS events
    FROM ev, (VALUES ('accepted'), ('refused')) AS sides(side)
    GROUP BY 1, 2
    """,
)
_sql("stream_funnel", "fun", "SELECT * FROM fun")
_sql("continued_funnel", "fun", "SELECT * FROM fun")

# ----------------------------------------------- sessions laid out or refreshed
for _way in ("laid_out", "refreshed"):
    _sql(f"{_way}_session_funnel", "fun", "SELECT * FROM fun")
    _sql(f"{_way}_velocity_metrics", "vel", "SELECT * FROM vel")
    _sql(f"{_way}_churn_features", "feat", "SELECT * FROM feat")

# ------------------------------------------------------------- damaged tables
# By table the damaged columns, each with how the sessions start
# (as in LIKE) it is damaged in and the value put there. Sessions that end in -1
# are missing, those in -2 are there twice, those in -3 also under another name.
DAMAGE = {
    "ev": {
        "event_name": ("1", "'none'"),
        "event_timestamp": ("2", "NULL"),
        "user_id": ("3", "NULL"),
        "experiment_id": ("4", "'EXP-000'"),
        "session_id": ("5", "NULL"),
        "variant": ("%-4", "CASE WHEN event_name = 'search' THEN 'none' ELSE 'treatment' END"),
    },
    "feat": {"churned": ("1", "NULL"), "purchased": ("2", "1")},
    "score": {
        "risk_band": ("1", "'none'"),
        "churn_risk_score": ("2", "101.0"),
        "churn_probability": ("3", "NULL"),
    },
    "cand": {"recommended_action": ("1", "'none'"), "intervention_priority": ("2", "'none'")},
    "roi": {"intervention_cost": ("1", "-1.0"), "roi_pct": ("2", "NULL")},
}


def damaged_value(table: str, column: str) -> str:
    """SQL of a damaged column, for both engines."""
    start, value = DAMAGE[table][column]
    return f"CASE WHEN session_id LIKE '{start}%' THEN {value} ELSE {column} END"


for _table, _columns in DAMAGE.items():
    _replaced = ", ".join(f"{damaged_value(_table, c)} AS {c}" for c in _columns)
    _fragment(
        f"{_table}_damaged",
        (_table,),
        f"""
        SELECT * REPLACE ({_replaced})
        FROM (SELECT * FROM {_table} WHERE session_id NOT LIKE '%-1'
              UNION ALL SELECT * FROM {_table} WHERE session_id LIKE '%-2'
              UNION ALL SELECT * REPLACE ('X' || session_id AS session_id) FROM {_table}
                        WHERE session_id LIKE '%-3')
        """,
    )
for _name, _needs, _table in (
    ("quality_report", "", "ev"),
    ("missing_ids", "", "ev"),
    ("session_boundary", "", "ev"),
    ("unstable_assignment", "", "ev"),
    ("inconsistent_users", "", "ev"),
    ("ml_integrity", "", "feat"),
    ("session_reconciliation", "feat score", "score"),
    ("score_contract", "feat score", "score"),
    ("candidate_contract", "score cand assume", "cand"),
    ("roi_contract", "port roi", "roi"),
):
    _final = re.sub(rf"\b{_table}\b", f"{_table}_damaged", _FINAL[_name])
    _sql(f"damaged_{_name}", f"{_needs} {_table}_damaged", _final)

# Tables against each other by content: scores as they are (left) and damaged (right).
_BY_CONTENT = """
    , sides AS (
        SELECT session_id, churn_probability, churn_risk_score, risk_band, 1 AS l, 0 AS r FROM score
        UNION ALL
        SELECT session_id, churn_probability, churn_risk_score, risk_band, 0 AS l, 1 AS r FROM {other}
    ), contents AS (
        SELECT session_id, churn_probability, churn_risk_score, risk_band, sum(l) AS l, sum(r) AS r
        FROM sides GROUP BY ALL
    ), differing AS (
        SELECT session_id, CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows,
               CASE WHEN session_id IS NULL THEN 'no_key' WHEN sum(r) = 0 THEN 'missing_right'
                    WHEN sum(l) = 0 THEN 'missing_left' WHEN sum(l) <> sum(r) THEN 'row_count'
                    ELSE 'changed' END AS status
        FROM contents GROUP BY session_id HAVING bool_or(l <> r) OR session_id IS NULL
    )
"""
_DIGESTS = """
    SELECT CAST(coalesce(sum(left_rows) FILTER (status IN ('no_key', 'missing_right')), 0) AS BIGINT) AS missing_right,
           CAST(coalesce(sum(right_rows) FILTER (status IN ('no_key', 'missing_left')), 0) AS BIGINT) AS missing_left,
           count(*) FILTER (status = 'row_count') AS repeated_keys,
           count(*) FILTER (status = 'changed') AS changed_keys, count(*) = 0 AS passed
    FROM differing
"""
for _name, _other, _final in (
    ("damaged_score_differences", "score_damaged", "SELECT * FROM differing"),
    ("damaged_score_digests", "score_damaged", _DIGESTS),
    ("score_digests", "score", _DIGESTS),
):
    _sql(_name, f"score {'' if _other == 'score' else _other}", _BY_CONTENT.format(other=_other) + _final)


# --------------------------------------------------- what holds of any model
_sql(
    "split",
    "feat",
    """
    , buckets AS (
        SELECT churned, CAST('0x' || substr(sha256(session_id || ':42'), 1, 4) AS INTEGER) AS bucket,
               count(*) AS n
        FROM feat GROUP BY 1, 2
    ), cuts AS (
        SELECT churned, max(bucket) FILTER (running - n < total * 0.2) AS cut
        FROM (SELECT *, sum(n) OVER (PARTITION BY churned ORDER BY bucket) AS running,
                     sum(n) OVER (PARTITION BY churned) AS total FROM buckets)
        GROUP BY 1
    )
    SELECT CASE WHEN bucket <= cut THEN 'test' ELSE 'train' END AS part, churned,
           CAST(sum(n) AS BIGINT) AS sessions
    FROM buckets JOIN cuts USING (churned)
    GROUP BY 1, 2
    """,
)
_ONE_HOT = " UNION ALL ".join(
    f"""
    SELECT session_id, churned, '{c}' AS name, {c} AS category FROM feat"""
    for c in S.CATEGORICAL_FEATURES
)
_sql(
    "preprocess",
    "feat",
    ", scaled AS ("
    + " UNION ALL ".join(
        f"""
        SELECT session_id, churned, {i} AS place,
               coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0) AS value
        FROM feat"""
        for i, c in enumerate(S.NUMERIC_FEATURES)
    )
    + f"""
    ), categories AS ({_ONE_HOT}
    ), ranked AS (
        SELECT name, category,
               row_number() OVER (
                 ORDER BY {" ".join(["CASE name"] + [f"WHEN '{c}' THEN {i}" for i, c in enumerate(S.CATEGORICAL_FEATURES)])} END,
                          count(*) DESC, category) + {len(S.NUMERIC_FEATURES) - 1} AS place
        FROM categories WHERE category IS NOT NULL GROUP BY 1, 2
    )
    SELECT session_id, churned, CAST(place AS INTEGER) AS place, round(value, 6) AS value FROM scaled
    UNION ALL
    SELECT c.session_id, c.churned, CAST(r.place AS INTEGER),
           CASE WHEN c.category = r.category THEN 1.0 ELSE 0.0 END
    FROM categories c JOIN ranked r USING (name)
    """,
)
_sql(
    "train_final",
    "feat",
    f"""
    SELECT count(*) AS training_sessions, {len(S.FEATURE_COLUMNS)} AS features,
           true AS model_saved
    FROM feat
    """,
)
_sql(
    "churn_risk_check",
    "feat",
    """
    SELECT count(*) AS sessions, CAST(0 AS BIGINT) AS outside_range, CAST(0 AS BIGINT) AS wrong_band
    FROM feat
    """,
)
_sql(
    "model_roundtrip",
    "feat",
    "SELECT count(*) AS sessions, CAST(0 AS BIGINT) AS changed_scores FROM feat",
)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
