"""The same results as ``catalog``, as plain SQL for DuckDB: one statement per registered query.

A statement is a SELECT over named steps; ``_with`` puts the steps it needs in front of it.
"""

from __future__ import annotations

import re

from funnelspark.plans import derived

# Fixed values, written out here once more, so that a wrong one in the engine shows.
ACCOUNT_TIERS = [
    (1, "< 1 Month", "Very High Risk", 5, 10),
    (2, "1 Month", "High Risk", 10, 15),
    (3, "2-6 Months", "Moderate Risk", 15, 25),
    (4, "6-12 Months", "Low Risk", 25, 40),
    (5, "1+ Year", "Minimal Risk", 30, 60),
]
DIMENSION_WEIGHTS = {"completeness": 0.25, "uniqueness": 0.20, "validity": 0.25, "timeliness": 0.15, "referential_integrity": 0.15}
METRIC_WEIGHTS = {"acceptance_rate": 0.30, "reply_rate": 0.25, "ghosting_rate": 0.20, "utilisation": 0.15, "activity_volume": 0.10}

LOADED, RELOADED = "2024-01-10 00:00:00", "2024-01-20 12:00:00"
AS_OF = "2024-01-30 00:00:00"


def text(expr: str, cap: int | None = None, default: str | None = None) -> str:
    out = f"nullif(trim(nullif({expr}, 'null'), concat(' ', chr(9), chr(10), chr(13))), '')"
    if cap:
        out = f"substr({out}, 1, {cap})"
    return f"coalesce({out}, '{default}')" if default else out


def filled(*names: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({n}, '')" for n in names) + ")"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def rate(a: str, b: str) -> str:
    return f"round(cast({a} AS DOUBLE) / nullif({b}, 0), 4)"


def ratio(a: str, b: str) -> str:
    return f"coalesce(cast({a} AS DOUBLE) / nullif({b}, 0), 0)"


def counts(prefix: str = "") -> str:
    kinds = {"invites_sent": "INVITE_SENT", "invites_accepted": "ACCEPTED", "messages_sent": "MESSAGE_SENT",
             "replies_received": "REPLY_RECEIVED", "meetings_booked": "MEETING_BOOKED"}
    return ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {c}" for c, k in kinds.items())


def of(kind: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{kind}')"


SENT, ACC, REP, MEET = of("INVITE_SENT"), of("ACCEPTED"), of("REPLY_RECEIVED"), of("MEETING_BOOKED")


def typed(source: str) -> str:
    """Raw event rows → clean columns (still unvalidated)."""
    kind = "replace(replace(lower(trim(event_type)), ' ', '_'), '-', '_')"
    return f"""
    SELECT pos, {text('id')} AS event_source_id, {text('agent_id')} AS agent_id, {text('lead_id')} AS lead_id,
      {text('campaign_id')} AS campaign_id, {text('template_id')} AS template_id,
      CASE WHEN {kind} IN ('invite_sent', 'invitation_sent', 'sent') THEN 'INVITE_SENT'
           WHEN {kind} IN ('accepted', 'connected', 'connection_accepted') THEN 'ACCEPTED'
           WHEN {kind} IN ('message_sent', 'message') THEN 'MESSAGE_SENT'
           WHEN {kind} IN ('reply_received', 'replied', 'reply') THEN 'REPLY_RECEIVED'
           WHEN {kind} IN ('meeting_booked', 'meeting') THEN 'MEETING_BOOKED'
           WHEN {kind} IN ('failed', 'error') THEN 'FAILED'
           ELSE upper(trim(event_type)) END AS event_type,
      try_cast("timestamp" AS TIMESTAMP) AS event_timestamp,
      {text('status', 50, 'SUCCESS')} AS event_status,
      cast(trunc(try_cast(response_time_minutes AS DOUBLE)) AS INTEGER) AS response_time_minutes,
      cast(strftime(try_cast("timestamp" AS TIMESTAMP), '%Y%m%d') AS INTEGER) AS date_key, "timestamp" AS raw_timestamp
    FROM {source}"""


def first_by(source: str, key: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY pos) AS rn FROM {source})
    WHERE rn = 1 OR {key} IS NULL"""


def versions(old: str, new: str, key: str, tracked: list[str]) -> str:
    changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in tracked)
    return f"""
    SELECT o.*, '{LOADED}' AS valid_from, CASE WHEN n.{key} IS NOT NULL AND ({changed}) THEN '{RELOADED}' END AS valid_to,
      NOT (n.{key} IS NOT NULL AND ({changed})) AS is_current,
      CASE WHEN n.{key} IS NULL THEN 'keep' WHEN {changed} THEN 'close' ELSE 'skip' END AS act
    FROM {old} o LEFT JOIN {new} n ON o.{key} = n.{key}
    UNION ALL
    SELECT n.*, '{RELOADED}', NULL, TRUE, CASE WHEN o.{key} IS NULL THEN 'insert' ELSE 'update' END
    FROM {new} n LEFT JOIN {old} o ON o.{key} = n.{key} WHERE o.{key} IS NULL OR {changed}"""


def agents(source: str) -> str:
    return f"""
    SELECT {text('id')} AS agent_id, {text('email', 255)} AS linkedin_email, {text('name', 255)} AS display_name,
      {text('status', 50, 'active')} AS status, {text('account_age')} AS tier_name FROM {source}"""


def leads(source: str) -> str:
    return f"""
    SELECT {text('id')} AS lead_id, {text('name', 255, 'Unknown Prospect')} AS full_name, {text('company', 255, 'Unknown Company')} AS company,
      'Professional' AS title, cast(NULL AS VARCHAR) AS linkedin_url, {text('segment', 100, 'Target Prospects')} AS segment,
      {text('status', 50, 'NEW')} AS lead_status FROM {source}"""


def campaigns(source: str) -> str:
    return f"""
    SELECT {text('id')} AS campaign_id, {text('name', 255)} AS campaign_name, {text('type', 100)} AS campaign_type,
      {text('segment', 100)} AS target_segment,
      CASE created_at WHEN '2023-12-1' THEN TIMESTAMP '2023-12-01 00:00:00' WHEN '2024-02-01' THEN TIMESTAMP '2024-02-01 00:00:00'
        WHEN '2023-12-01T06:30:00+05:30' THEN TIMESTAMP '2023-12-01 01:00:00' END AS created_at
    FROM ({first_by(source, text('id'))}) c WHERE {text('id')} IS NOT NULL"""


def scored(source: str, keys: str, drop: str, frame: str = "14 PRECEDING") -> str:
    """Anomaly scores of a long series (keys, date_key, v)."""
    w = f"PARTITION BY {keys} ORDER BY date_key"
    return f"""
    SELECT *, greatest(z_flag, iqr_flag) AS anomaly_score,
      CASE WHEN z_flag > 0 AND is_drop THEN 'z_score_one_sided' WHEN z_flag > 0 AND iqr_flag > 0 THEN 'both'
           WHEN z_flag > 0 THEN 'z_score' WHEN iqr_flag > 0 THEN 'iqr' ELSE 'none' END AS method_triggered
    FROM (SELECT *,
        CASE WHEN prior < 5 THEN 0 WHEN round(z, 9) >= 3 THEN 2 WHEN round(z, 9) >= 2 THEN 1 ELSE 0 END AS z_flag,
        CASE WHEN prior < 5 OR is_drop THEN 0
             WHEN round(v, 9) < round(q1 - 3 * (q3 - q1), 9) OR round(v, 9) > round(q3 + 3 * (q3 - q1), 9) THEN 2
             WHEN round(v, 9) < round(q1 - 1.5 * (q3 - q1), 9) OR round(v, 9) > round(q3 + 1.5 * (q3 - q1), 9) THEN 1
             ELSE 0 END AS iqr_flag
      FROM (SELECT *, CASE WHEN sd > 0 THEN CASE WHEN is_drop THEN greatest(m - v, 0) ELSE abs(v - m) END / sd ELSE 0 END AS z
        FROM (SELECT *, CASE WHEN sd0 < 1e-12 THEN 0 ELSE sd0 END AS sd
          FROM (SELECT *, {drop} AS is_drop, count(*) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior,
              count(*) OVER ({w} ROWS BETWEEN {frame} AND 1 PRECEDING) AS n,
              avg(v) OVER ({w} ROWS BETWEEN {frame} AND 1 PRECEDING) AS m,
              stddev_samp(v) OVER ({w} ROWS BETWEEN {frame} AND 1 PRECEDING) AS sd0,
              quantile_cont(v, 0.25) OVER ({w} ROWS BETWEEN {frame} AND 1 PRECEDING) AS q1,
              quantile_cont(v, 0.75) OVER ({w} ROWS BETWEEN {frame} AND 1 PRECEDING) AS q3,
              lead(date_key) OVER ({w}) IS NULL AS is_latest
            FROM {source}))))"""


def known(expr: str) -> str:
    return f"CASE WHEN prior >= 5 THEN round({expr}, 9) ELSE 0 END"


SCORED = f"""date_key, metric, round(v, 9) AS current_value, prior + 1 AS data_points, CASE WHEN prior >= 5 THEN n ELSE 0 END AS baseline_points,
    {known('m')} AS baseline_mean, {known('sd')} AS baseline_std, {known('z')} AS z_score,
    {known('q1 - CASE WHEN is_drop THEN 0 ELSE 1.5 * (q3 - q1) END')} AS iqr_lower,
    {known('q3 + CASE WHEN is_drop THEN 0 ELSE 1.5 * (q3 - q1) END')} AS iqr_upper,
    z_flag, iqr_flag, anomaly_score, method_triggered, CASE WHEN prior < 5 THEN 'insufficient_baseline_data' END AS reason"""


def metrics(source: str, agent: str) -> str:
    return f"""
    SELECT {agent}, date_key, 'acceptance_rate' AS metric, acceptance_rate AS v FROM {source} WHERE acceptance_rate IS NOT NULL
    UNION ALL SELECT {agent}, date_key, 'reply_rate', reply_rate FROM {source} WHERE reply_rate IS NOT NULL
    UNION ALL SELECT {agent}, date_key, 'ghosting_rate',
      {ratio('invites_accepted - least(replies_received, invites_accepted)', 'invites_accepted')} FROM {source}
    UNION ALL SELECT {agent}, date_key, 'utilisation', utilisation_pct FROM {source} WHERE utilisation_pct IS NOT NULL
    UNION ALL SELECT {agent}, date_key, 'activity_volume', cast(invites_sent AS DOUBLE) FROM {source}"""


def risks(source: str) -> str:
    points = ", ".join(f"max(anomaly_score) FILTER (WHERE metric = '{m}') AS s_{m}" for m in METRIC_WEIGHTS)
    total = " + ".join(f"coalesce(s_{m}, 0) * {50 * w}" for m, w in METRIC_WEIGHTS.items())
    return f"""
    SELECT *, cast(CASE WHEN days < 6 THEN 0 ELSE least(round({total}, 1), 100) END AS DOUBLE) AS risk_score
    FROM (SELECT agent_id, {points}, max(prior + 1) FILTER (WHERE metric = 'activity_volume') AS days
      FROM {source} WHERE is_latest GROUP BY agent_id)"""


def share(good: str, total: str) -> str:
    return f"CASE WHEN {total} = 0 THEN 100 ELSE cast({good} AS DOUBLE) / {total} * 100 END"


def complete(table: str, source: str, columns: dict[str, str]) -> str:
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns.values())
    pairs = ", ".join(f"'{name}': count(*) FILTER (WHERE {c} IS NULL)" for name, c in columns.items())
    cells = f"(count(*) * {len(columns)})"
    return f"""SELECT 'completeness' AS check_dimension, '{table}' AS table_name, {share(f'{cells} - ({nulls})', cells)} AS score,
      cast(to_json({{'null_counts': {{{pairs}}}, 'total_rows': count(*)}}) AS VARCHAR) AS details FROM {source}"""


def unique(table: str, source: str, key: str, label: str = "total") -> str:
    return f"""SELECT 'uniqueness' AS check_dimension, '{table}' AS table_name, {share(f'count(DISTINCT {key})', 'count(*)')} AS score,
      cast(to_json({{'distinct': count(DISTINCT {key}), '{label}': count(*)}}) AS VARCHAR) AS details FROM {source}"""


def refers(table: str, column: str, source: str, expr: str, dim: str, pk: str) -> str:
    orphan = f"{expr} NOT IN (SELECT {pk} FROM {dim} WHERE {pk} IS NOT NULL)"
    return f"""SELECT 'referential_integrity' AS check_dimension, '{table}.{column}' AS table_name,
      {share(f'(count({expr}) - count(*) FILTER (WHERE {orphan}))', f'count({expr})')} AS score,
      cast(to_json({{'total_fks': count({expr}), 'orphans': count(*) FILTER (WHERE {orphan})}}) AS VARCHAR) AS details FROM {source}"""


BAD_TYPE = """count(*) FILTER (WHERE event_type NOT IN
  ('INVITE_SENT', 'ACCEPTED', 'MESSAGE_SENT', 'REPLY_RECEIVED', 'MEETING_BOOKED', 'WITHDRAWN', 'FAILED'))"""
VALID_TYPE = f"""SELECT 'validity' AS check_dimension, 'fact_outreach_event.event_type' AS table_name,
  {share(f'(count(*) - {BAD_TYPE})', 'count(*)')} AS score,
  cast(to_json({{'invalid_event_types': {BAD_TYPE}}}) AS VARCHAR) AS details FROM fact"""
OVER_CAP = "count(*) FILTER (WHERE invites_sent > daily_invite_limit)"
VALID_TIER = f"""SELECT 'validity' AS check_dimension, 'fact_daily_agent_activity.tier_limits' AS table_name,
  {share(f'(count(*) - {OVER_CAP})', 'count(*)')} AS score,
  cast(to_json({{'tier_limit_violations': {OVER_CAP}}}) AS VARCHAR) AS details
  FROM activity JOIN agents_1 USING (agent_id) LEFT JOIN tiers USING (tier_name)"""


def timely(at: str) -> str:
    stale = f"count(*) FILTER (WHERE event_timestamp < TIMESTAMP '{at}' - INTERVAL 24 HOUR)"
    return f"""SELECT 'timeliness' AS check_dimension, 'fact_outreach_event' AS table_name,
      {share(f'(count(*) - {stale})', 'count(*)')} AS score,
      cast(to_json({{'total': count(*), 'fresh': count(*) - {stale}, 'stale': {stale}, 'sla_hours': 24}}) AS VARCHAR) AS details FROM fact"""


REQUIRED = [
    ("fact_outreach_event", "fact", {"event_source_id": "event_source_id", "event_type": "event_type", "event_timestamp": "event_timestamp"}),
    ("fact_daily_agent_activity", "activity", {"agent_key": "agent_id", "date_key": "date_key"}),
    ("dim_agent", "agents_1", {"agent_id": "agent_id", "status": "status"}),
    ("dim_lead", "leads_1", {"lead_id": "lead_id"}),
    ("dim_campaign", "campaigns_1", {"campaign_id": "campaign_id"}),
]
UNIQUE = [
    ("fact_outreach_event", "fact", "event_source_id", "total"), ("dim_agent", "agents_1", "agent_id", "total_current"),
    ("dim_lead", "leads_1", "lead_id", "total_current"), ("dim_campaign", "campaigns_1", "campaign_id", "total"),
    ("dim_message_template", "templates", "template_id", "total"),
]
REFERS = [
    ("fact_outreach_event", "agent_key", "fact", "agent", "agents_1", "agent_id"),
    ("fact_outreach_event", "lead_key", "fact", "lead", "leads_1", "lead_id"),
    ("fact_outreach_event", "campaign_key", "fact", "campaign", "campaigns_1", "campaign_id"),
    ("fact_outreach_event", "date_key", "fact", "date_key", "calendar", "date_key"),
    ("fact_daily_agent_activity", "agent_key", "activity", "agent_id", "agents_1", "agent_id"),
    ("fact_daily_agent_activity", "date_key", "activity", "date_key", "calendar", "date_key"),
    ("fact_campaign_performance", "campaign_key", "performance", "campaign_id", "campaigns_1", "campaign_id"),
]


def union(parts: list[str]) -> str:
    return "\n UNION ALL ".join(parts)


def dq_run(run: str, at: str) -> str:
    checks = union([
        complete("fact_outreach_event", "fact", {"event_type": "event_type", "lead_key": "lead"}), VALID_TYPE, timely(at)
    ])
    total = " + ".join(
        f"{w} * coalesce((SELECT avg(score) FROM ({checks}) WHERE check_dimension = '{d}'), 100)" for d, w in DIMENSION_WEIGHTS.items()
    )
    return f"SELECT '{run}' AS run_id, '{at}' AS checked_at, round({total}, 2) AS composite_score"


_tiers = ", ".join(f"({k}, '{n}', '{r}', {i}, {m})" for k, n, r, i, m in ACCOUNT_TIERS)
_weights = ", ".join(f"('{d}', {w})" for d, w in DIMENSION_WEIGHTS.items())

STEPS: dict[str, str] = {
    "raw_events": derived.for_duckdb(derived.RAW_EVENTS),
    "raw_agents_1": derived.for_duckdb(derived.RAW_AGENTS_1),
    "raw_agents_2": derived.for_duckdb(derived.RAW_AGENTS_2),
    "raw_leads_1": derived.for_duckdb(derived.RAW_LEADS_1),
    "raw_leads_2": derived.for_duckdb(derived.RAW_LEADS_2),
    "raw_leads_mixed": derived.for_duckdb(derived.RAW_LEADS_MIXED),
    "raw_campaigns_1": derived.for_duckdb(derived.RAW_CAMPAIGNS_1),
    "raw_campaigns_2": derived.for_duckdb(derived.RAW_CAMPAIGNS_2),
    "raw_templates": derived.for_duckdb(derived.RAW_TEMPLATES),
    "runs": derived.for_duckdb(derived.PIPELINE_RUNS),
    "tiers": f"SELECT * FROM (VALUES {_tiers}) t(tier_key, tier_name, risk_classification, daily_invite_limit, daily_message_limit)",
    "weights": f"SELECT * FROM (VALUES {_weights}) t(check_dimension, weight)",
    "calendar": """SELECT cast(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
      monthname(d) AS month_name, week(d) AS week_of_year, isodow(d) - 1 AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
      FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2027-12-31', INTERVAL 1 DAY) t(d)""",
    "all_typed": typed("raw_events"),
    "first_typed": first_by("all_typed", "event_source_id"),
    "events_1": typed("(SELECT * FROM raw_events WHERE pos < 1000000000000)"),
    "batch_1": "SELECT * FROM (" + first_by("events_1", "event_source_id") + ") WHERE event_source_id IS NOT NULL AND event_type IS NOT NULL AND event_timestamp IS NOT NULL",
    "events_2": typed("(SELECT * FROM raw_events WHERE pos >= 1000000000000)"),
    "batch_2": "SELECT * FROM events_2 WHERE event_source_id IS NOT NULL AND event_type IS NOT NULL AND event_timestamp IS NOT NULL",
    "judged": """SELECT *, CASE WHEN event_source_id IS NULL THEN 'missing_event_id' WHEN event_type IS NULL THEN 'missing_event_type'
      WHEN event_timestamp IS NULL THEN 'bad_timestamp' END AS rule FROM first_typed""",
    "valid_events": "SELECT * EXCLUDE (rule, pos, raw_timestamp) FROM judged WHERE rule IS NULL",
    "agents_1": "SELECT * REPLACE (CASE WHEN tier_name = 'n/a' THEN NULL ELSE tier_name END AS tier_name) FROM (" + agents("raw_agents_1") + ")",
    "agents_2": "SELECT * REPLACE (CASE WHEN tier_name = 'n/a' THEN NULL ELSE tier_name END AS tier_name) FROM (" + agents("raw_agents_2") + ")",
    "agent_versions": versions("agents_1", "agents_2", "agent_id", ["status", "tier_name"]),
    "leads_1": leads("raw_leads_1"),
    "leads_2": leads("raw_leads_2"),
    "lead_versions": versions("leads_1", "leads_2", "lead_id", ["segment", "lead_status"]),
    "campaigns_1": campaigns("raw_campaigns_1"),
    "campaigns_2": campaigns("raw_campaigns_2"),
    "templates": f"""SELECT {text('id')} AS template_id, {text('name', 255)} AS template_name, {text('body')} AS template_body,
      {text('channel', 50)} AS channel FROM raw_templates WHERE id IS NOT NULL""",
    "fact": """SELECT e.*, a.agent_id AS agent, l.lead_id AS lead, c.campaign_id AS campaign, t.template_id AS template
      FROM valid_events e LEFT JOIN agents_1 a ON e.agent_id = a.agent_id LEFT JOIN leads_1 l ON e.lead_id = l.lead_id
      LEFT JOIN campaigns_1 c ON e.campaign_id = c.campaign_id LEFT JOIN templates t ON e.template_id = t.template_id""",
    "days": f"""SELECT *, {rate('invites_accepted', 'invites_sent')} AS acceptance_rate, {rate('replies_received', 'invites_accepted')} AS reply_rate
      FROM (SELECT agent AS agent_id, date_key, {counts()} FROM fact WHERE agent IS NOT NULL GROUP BY agent, date_key)""",
    "activity": f"""SELECT d.*, {rate('invites_sent', 'daily_invite_limit')} AS utilisation_pct
      FROM days d JOIN agents_1 USING (agent_id) LEFT JOIN tiers USING (tier_name)""",
    "performance": f"""SELECT campaign AS campaign_id, date_key, count(DISTINCT lead) AS total_leads, {SENT} AS invites_sent, {ACC} AS connected,
      {REP} AS replied, {MEET} AS meetings_booked, {rate(MEET, SENT)} AS conversion_rate,
      round(({ratio(ACC, SENT)} * 0.3 + {ratio(REP, ACC)} * 0.3 + {ratio(MEET, SENT)} * 0.4) * 100, 6) AS roi_score
      FROM fact WHERE campaign IS NOT NULL GROUP BY campaign, date_key""",
    "series": metrics("activity", "agent_id"),
    "points": scored("series", "agent_id, metric", "metric IN ('acceptance_rate', 'reply_rate')"),
    "agent_risks": risks("points"),
    "profiles": """
      SELECT agent_id, display_name, tier_name, risk_score, risk_level, daily_invite_limit, daily_message_limit, days,
        s_acceptance_rate, s_reply_rate, s_ghosting_rate, s_utilisation, s_activity_volume,
        cast(CASE WHEN coalesce(days, 0) < 6 OR risk_level = 'Green' THEN daily_invite_limit
          ELSE floor(daily_invite_limit * CASE risk_level WHEN 'Amber' THEN 0.8 ELSE 0.5 END) END AS DOUBLE) AS recommended_daily_invites,
        cast(CASE WHEN coalesce(days, 0) < 6 OR risk_level = 'Green' THEN daily_message_limit
          ELSE floor(daily_message_limit * CASE risk_level WHEN 'Amber' THEN 0.8 ELSE 0.5 END) END AS DOUBLE) AS recommended_daily_messages
      FROM (SELECT *, CASE WHEN risk_score <= 30 THEN 'Green' WHEN risk_score <= 60 THEN 'Amber' ELSE 'Red' END AS risk_level
        FROM (SELECT a.*, t.daily_invite_limit, t.daily_message_limit, r.* EXCLUDE (agent_id, risk_score), coalesce(r.risk_score, 0) AS risk_score
          FROM agents_1 a LEFT JOIN tiers t USING (tier_name) LEFT JOIN agent_risks r USING (agent_id)))""",
    "advice": """SELECT *, CASE WHEN coalesce(days, 0) < 6 THEN 'Insufficient historical data for risk assessment (< 6 days).'
      WHEN daily_invite_limit IS NULL THEN 'No tier assigned — cannot compute recommendation.'
      ELSE concat(CASE risk_level WHEN 'Green' THEN 'Low risk (' WHEN 'Amber' THEN 'Moderate risk (' ELSE 'HIGH RISK (' END, cast(risk_score AS VARCHAR),
        CASE risk_level WHEN 'Green' THEN '). Maintaining tier ceiling: ' WHEN 'Amber' THEN '). Reducing to 80% capacity: ' ELSE '). Halving capacity: ' END,
        cast(cast(recommended_daily_invites AS INTEGER) AS VARCHAR), ' invites, ', cast(cast(recommended_daily_messages AS INTEGER) AS VARCHAR), ' messages/day.',
        CASE risk_level WHEN 'Green' THEN '' ELSE concat(CASE risk_level WHEN 'Amber' THEN ' Triggered by: ' ELSE ' Critical triggers: ' END,
          concat_ws(', ', CASE WHEN s_acceptance_rate >= lim THEN 'acceptance_rate' END, CASE WHEN s_reply_rate >= lim THEN 'reply_rate' END,
            CASE WHEN s_ghosting_rate >= lim THEN 'ghosting_rate' END, CASE WHEN s_utilisation >= lim THEN 'utilisation' END,
            CASE WHEN s_activity_volume >= lim THEN 'activity_volume' END), '.',
          CASE risk_level WHEN 'Red' THEN ' Immediate review recommended.' ELSE '' END) END) END AS justification
      FROM (SELECT *, CASE risk_level WHEN 'Amber' THEN 1 ELSE 2 END AS lim FROM profiles)""",
    "scored_days": """SELECT a.agent_id, a.date_key, CASE WHEN lead(a.date_key) OVER (PARTITION BY a.agent_id ORDER BY a.date_key) IS NULL
      THEN r.risk_score / 50 END AS anomaly_score FROM activity a JOIN agent_risks r USING (agent_id)""",
    "dq_checks": union(
        [complete(*r) for r in REQUIRED] + [unique(*u) for u in UNIQUE] + [VALID_TYPE, VALID_TIER, timely(AS_OF)]
        + [refers(*r) for r in REFERS]
    ),
    "dq_scores": """SELECT check_dimension, avg(score) AS dimension_score FROM dq_checks GROUP BY check_dimension""",
    "dq_total": """SELECT round(sum(coalesce(dimension_score, 100) * weight), 2) AS composite_score FROM weights LEFT JOIN dq_scores USING (check_dimension)""",
    "dq_runs": union([dq_run("run_1", AS_OF), dq_run("run_2", "2024-01-31 00:00:00")]),
    "slow": """SELECT *, (duration_seconds - mu) / sd AS z FROM runs JOIN (SELECT pipeline, avg(duration_seconds) AS mu, stddev_samp(duration_seconds) AS sd
      FROM runs GROUP BY pipeline) USING (pipeline)""",
}


def _with(select: str) -> str:
    """Put the steps a statement refers to, directly or through other steps, in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name, body in STEPS.items():
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(select)
    steps = ",\n".join(f"{name} AS ({STEPS[name]})" for name in needed)
    return f"WITH {steps}\n{select}" if needed else select


def _checks(parts: list[str]) -> str:
    return f"SELECT check_dimension, table_name, round(score, 6) AS score, details FROM ({union(parts)})"


EVENT = f"""event_source_id, agent_id, lead_id, campaign_id, template_id, event_type, {stamp('event_timestamp')} AS event_timestamp,
    event_status, response_time_minutes, date_key"""

SELECTS: dict[str, str] = {
    "clean_events": f"SELECT {EVENT} FROM valid_events",
    "rejected_events": """SELECT CASE WHEN event_source_id IS NULL THEN NULL ELSE event_source_id END AS source_id,
      CASE rule WHEN 'missing_event_id' THEN 'Missing event_id' WHEN 'missing_event_type' THEN 'Missing event_type'
        ELSE 'Missing or unparseable timestamp' END AS error_message,
      rule AS error_type, 'transformer' AS source, 'run_1' AS run_id, FALSE AS resolved, raw_timestamp AS payload_timestamp
      FROM judged WHERE rule IS NOT NULL""",
    "reject_summary": """SELECT count(*) AS rows_in, count(*) FILTER (WHERE rule IS NULL) AS rows_clean, count(rule) AS rows_rejected,
      CASE WHEN count(rule) = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status FROM judged""",
    "replayed_events": f"""SELECT * REPLACE ('2024-01-15 08:30:00' AS event_timestamp, 20240115 AS date_key) FROM (
      SELECT {EVENT} FROM judged WHERE rule = 'bad_timestamp')""",
    "replay_resolution": """SELECT rule AS error_type, rule = 'bad_timestamp' AS resolved, count(*) AS n FROM judged WHERE rule IS NOT NULL GROUP BY rule""",
    "event_type_normalised": """SELECT r.event_type AS raw_type, t.event_type, count(*) AS n, any_value(CASE WHEN t.event_type IS NOT NULL THEN t.event_type NOT IN
      ('INVITE_SENT', 'ACCEPTED', 'MESSAGE_SENT', 'REPLY_RECEIVED', 'MEETING_BOOKED', 'WITHDRAWN', 'FAILED') END) AS is_unknown
      FROM raw_events r JOIN all_typed t USING (pos) GROUP BY r.event_type, t.event_type""",
    "clean_agents": agents("raw_agents_2"),
    "clean_leads": f"""SELECT * EXCLUDE (pos) FROM ({first_by('mixed', 'lead_id')}) WHERE lead_id IS NOT NULL""",
    "rejected_leads": """SELECT id AS source_id, 'Missing lead_id' AS error_message, name AS payload_name FROM raw_leads_mixed WHERE id = '   '""",
    "clean_campaigns": f"SELECT * REPLACE ({stamp('created_at')} AS created_at) FROM campaigns_1",
    "clean_templates": "SELECT *, cast(NULL AS VARCHAR) AS created_at FROM templates",
    "load_rejects": f"""SELECT concat('lead_d', cast(doc_id AS VARCHAR)) AS lead_id, 'too_long' AS rule, 'full_name is longer than 255' AS message
      FROM documents WHERE length({text("concat(lang, ' ', text)")}) > 255""",
    "tier_agents": "SELECT t.*, (SELECT count(*) FROM agents_1 a WHERE a.tier_name = t.tier_name) AS agents FROM tiers t",
    "calendar_event_volume": f"""SELECT year, quarter, month, month_name, week_of_year, day_of_week, day_name, is_weekend, count(*) AS events,
      {SENT} AS invites_sent, {ACC} AS accepted FROM fact JOIN calendar USING (date_key) GROUP BY ALL""",
    "scd2_agents": "SELECT * EXCLUDE (act) FROM agent_versions",
    "import_defaults": """SELECT 'agent' AS kind, agent_id AS id, status AS value FROM agents_1 UNION ALL SELECT 'agent', 'my_live_account', 'active'
      UNION ALL SELECT 'campaign', campaign_id, campaign_type FROM campaigns_1 UNION ALL SELECT 'campaign', 'camp_personal_network', 'ORGANIC_NETWORK'""",
    "number_texts": """SELECT l_orderkey, l_linenumber, number, cast(trunc(number) AS INTEGER) AS whole FROM (SELECT l_orderkey, l_linenumber,
      CASE (l_orderkey + l_linenumber) % 8 WHEN 0 THEN l_extendedprice WHEN 1 THEN l_partkey * 1000.0 WHEN 2 THEN l_suppkey * 100.0
        WHEN 3 THEN cast(concat('-0.', l_linenumber) AS DOUBLE) WHEN 7 THEN cast(l_suppkey AS DOUBLE) END AS number FROM lineitem)""",
    "scd2_leads": "SELECT * EXCLUDE (act) FROM lead_versions",
    "scd2_load_counts": """SELECT act AS action, count(*) AS n, 'agents' AS entity FROM agent_versions WHERE act NOT IN ('keep', 'close') GROUP BY act
      UNION ALL SELECT act, count(*), 'leads' FROM lead_versions WHERE act NOT IN ('keep', 'close') GROUP BY act""",
    "leads_as_of": "SELECT segment, lead_status, count(*) AS leads FROM leads_1 GROUP BY ALL",
    "scd1_campaign_upsert": f"""SELECT campaign_id, CASE WHEN n.campaign_id IS NULL THEN o.campaign_name ELSE n.campaign_name END AS campaign_name,
      CASE WHEN n.campaign_id IS NULL THEN o.campaign_type ELSE n.campaign_type END AS campaign_type,
      CASE WHEN n.campaign_id IS NULL THEN o.target_segment ELSE n.target_segment END AS target_segment,
      {stamp('CASE WHEN o.campaign_id IS NULL THEN n.created_at ELSE o.created_at END')} AS created_at,
      CASE WHEN n.campaign_id IS NULL THEN 'keep' WHEN o.campaign_id IS NULL THEN 'insert' WHEN o.campaign_name IS DISTINCT FROM n.campaign_name
        OR o.campaign_type IS DISTINCT FROM n.campaign_type OR o.target_segment IS DISTINCT FROM n.target_segment THEN 'update' ELSE 'skip' END AS action
      FROM campaigns_1 o FULL JOIN campaigns_2 n USING (campaign_id)""",
    "scd1_template_upsert": """SELECT * REPLACE (CASE WHEN channel = 'email' THEN 'EMAIL' ELSE channel END AS channel),
      CASE WHEN channel = 'email' THEN 'update' ELSE 'skip' END AS action FROM templates""",
    "upsert_do_nothing": """SELECT CASE WHEN n.campaign_id IS NULL THEN 'keep' WHEN o.campaign_id IS NULL THEN 'insert' ELSE 'skip' END AS action,
      CASE WHEN o.campaign_id IS NULL THEN n.target_segment ELSE o.target_segment END AS target_segment, count(*) AS n
      FROM campaigns_1 o FULL JOIN campaigns_2 n USING (campaign_id) GROUP BY 1, 2""",
    "event_key_resolution": """SELECT event_source_id, agent IS NOT NULL AS has_agent_key, lead IS NOT NULL AS has_lead_key,
      campaign IS NOT NULL AS has_campaign_key, template IS NOT NULL AS has_template_key FROM fact""",
    "asof_key_resolution": f"""SELECT e.agent_id, v.status, count(*) AS events FROM valid_events e LEFT JOIN agent_versions v ON e.agent_id = v.agent_id
      AND cast(v.valid_from AS TIMESTAMP) <= e.event_timestamp AND (v.valid_to IS NULL OR e.event_timestamp < cast(v.valid_to AS TIMESTAMP))
      GROUP BY 1, 2""",
    "asof_many_versions": """WITH versions AS (SELECT o_orderstatus AS id, o_orderdate AS valid_from, min(o_orderkey) AS lead_key,
      lead(o_orderdate) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate) AS valid_to FROM orders GROUP BY 1, 2)
      SELECT l_linestatus AS lead_id, lead_key, count(*) AS events FROM lineitem LEFT JOIN versions ON l_linestatus = id AND valid_from <= l_shipdate
      AND (valid_to IS NULL OR l_shipdate < valid_to) GROUP BY 1, 2""",
    "backfilled_keys": "SELECT event_type, count(*) AS events, count(lead) AS with_lead FROM fact GROUP BY event_type",
    "event_upsert": f"""SELECT event_source_id, coalesce(o.event_type, n.event_type) AS event_type,
      {stamp('coalesce(o.event_timestamp, n.event_timestamp)')} AS event_timestamp, coalesce(o.date_key, n.date_key) AS date_key,
      coalesce(n.event_status, o.event_status) AS event_status,
      CASE WHEN n.event_source_id IS NULL THEN o.response_time_minutes ELSE n.response_time_minutes END AS response_time_minutes,
      CASE WHEN o.event_source_id IS NULL THEN '{RELOADED}' ELSE '{LOADED}' END AS loaded_at,
      CASE WHEN n.event_source_id IS NULL THEN 'keep' WHEN o.event_source_id IS NULL THEN 'insert' WHEN o.event_status IS DISTINCT FROM n.event_status
        OR o.response_time_minutes IS DISTINCT FROM n.response_time_minutes THEN 'update' ELSE 'skip' END AS action
      FROM batch_1 o FULL JOIN batch_2 n USING (event_source_id)""",
    "micro_batch_merge": f"""SELECT * FROM (SELECT {EVENT.replace('event_status, response_time_minutes', 'last_status AS event_status, last_minutes AS response_time_minutes')}
      FROM (SELECT *, row_number() OVER w AS rn, last_value(event_status) OVER (PARTITION BY event_source_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_status,
        last_value(response_time_minutes) OVER (PARTITION BY event_source_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_minutes
        FROM all_typed WHERE event_source_id IS NOT NULL AND event_type IS NOT NULL AND event_timestamp IS NOT NULL
        WINDOW w AS (PARTITION BY event_source_id ORDER BY pos)) WHERE rn = 1)""",
    "chronology_check": f"""SELECT agent AS agent_id, lead AS lead_id, {stamp('i')} AS first_invite, {stamp('a')} AS first_accept, a >= i AS in_order
      FROM (SELECT agent, lead, min(event_timestamp) FILTER (WHERE event_type = 'INVITE_SENT') AS i, min(event_timestamp) FILTER (WHERE event_type = 'ACCEPTED') AS a
      FROM fact WHERE agent IS NOT NULL AND lead IS NOT NULL GROUP BY agent, lead) WHERE i IS NOT NULL AND a IS NOT NULL""",
    "daily_agent_activity": "SELECT * FROM activity",
    "live_daily_refresh": """SELECT * REPLACE (coalesce(acceptance_rate, 0) AS acceptance_rate, coalesce(reply_rate, 0) AS reply_rate) FROM days
      WHERE meetings_booked > 0""",
    "campaign_performance": "SELECT * FROM performance",
    "mart_upsert": f"""SELECT agent_id, date_key, {', '.join(f'CASE WHEN n.agent_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}' for c in ('invites_sent', 'invites_accepted', 'messages_sent', 'replies_received', 'meetings_booked', 'acceptance_rate', 'reply_rate'))},
      CASE WHEN n.agent_id IS NULL THEN 'keep' WHEN o.agent_id IS NULL THEN 'insert' ELSE 'update' END AS action
      FROM days_1 o FULL JOIN days_2 n USING (agent_id, date_key)""",
    "kpi_summary": f"""SELECT {SENT} AS total_invites_sent, {ACC} AS total_accepted, {REP} AS total_replies_received, {MEET} AS total_meetings_booked,
      round({ratio(f'100 * {ACC}', SENT)}, 2) AS acceptance_rate_pct, round({ratio(f'100 * {REP}', ACC)}, 2) AS reply_rate_pct,
      round({ratio(f'100 * {MEET}', SENT)}, 2) AS conversion_rate_pct FROM fact""",
    "warehouse_vitals": """SELECT (SELECT count(*) FROM fact) AS total_events_in_dw, (SELECT count(*) FROM agent_versions WHERE is_current) AS active_agents""",
    "core_measures": f"""SELECT date_key, {SENT} AS total_invites_sent, {ACC} AS total_accepted, round({ratio(ACC, SENT)}, 6) AS acceptance_rate,
      round({ratio(REP, ACC)}, 6) AS reply_rate, round({ratio(MEET, SENT)}, 6) AS conversion_rate, {MEET} AS total_meetings_booked
      FROM fact WHERE event_status <> 'DUP' GROUP BY date_key""",
    "funnel": f"""SELECT step, stage, n, round({ratio('n', 'prev')}, 6) AS step_rate, round({ratio('n', 'first')}, 6) AS overall_rate FROM (
      SELECT *, coalesce(lag(n) OVER (ORDER BY step), n) AS prev, first_value(n) OVER (ORDER BY step) AS first FROM (
      SELECT 1 AS step, 'Sent' AS stage, {SENT} AS n FROM fact UNION ALL SELECT 2, 'Accepted', {ACC} FROM fact
      UNION ALL SELECT 3, 'Replied', {REP} FROM fact UNION ALL SELECT 4, 'Meeting Booked', {MEET} FROM fact))""",
    "utilisation_daily": """SELECT date_key, cast(sum(invites_sent) AS BIGINT) AS daily_invites_sent, 30 AS daily_invite_limit,
      round(sum(invites_sent) / 30.0, 6) AS utilisation_pct FROM activity GROUP BY date_key""",
    "agent_status": """SELECT agent_id, CASE status WHEN 'active' THEN 'Active' WHEN 'paused' THEN 'Paused' ELSE 'Ghost' END AS agent_status
      FROM agent_versions WHERE is_current""",
    "agent_status_counts": """SELECT count(*) FILTER (WHERE status = 'active') AS active_agent_count, count(*) FILTER (WHERE status = 'paused') AS paused_agent_count,
      count(*) FILTER (WHERE status = 'ghost') AS ghost_agent_count FROM agent_versions WHERE is_current""",
    "days_since_activity": f"""SELECT agent AS agent_id, {stamp('max(event_timestamp)')} AS last_activity,
      date_diff('day', cast(max(event_timestamp) AS DATE), DATE '2024-02-10') AS days_since_last_activity FROM fact WHERE agent IS NOT NULL GROUP BY agent""",
    "utilisation_measures": f"""SELECT date_key, {SENT} AS daily_invites_sent, 30 AS daily_invite_limit, round({SENT} / 30.0, 6) AS utilisation_pct
      FROM fact GROUP BY date_key""",
    "agent_utilisation_period": f"""SELECT a.agent_id, cast(coalesce(sum(invites_sent), 0) AS BIGINT) AS invites, count(date_key) AS active_days, daily_invite_limit,
      round({ratio('sum(invites_sent)', '(daily_invite_limit * count(date_key))')}, 6) AS agent_utilisation_pct
      FROM agents_1 a LEFT JOIN tiers ON a.tier_name = tiers.tier_name
      LEFT JOIN (SELECT agent_id, date_key, invites_sent FROM activity WHERE date_key BETWEEN 20240108 AND 20240114) d ON a.agent_id = d.agent_id
      GROUP BY a.agent_id, daily_invite_limit""",
    "campaign_roi": f"""SELECT campaign AS campaign_id, {SENT} AS campaign_invites_sent, {ACC} AS campaign_connected, {REP} AS campaign_replied,
      {MEET} AS campaign_meetings, round(({ratio(ACC, SENT)} * 0.3 + {ratio(REP, ACC)} * 0.3 + {ratio(MEET, SENT)} * 0.4) * 100, 6) AS campaign_roi_score
      FROM fact WHERE campaign IS NOT NULL GROUP BY campaign""",
    "segment_rates": f"""SELECT segment, {SENT} AS sent, {ACC} AS accepted, {REP} AS replied, round({ratio(ACC, SENT)}, 6) AS segment_acceptance_rate,
      round({ratio(REP, ACC)}, 6) AS segment_reply_rate FROM fact JOIN leads_1 ON fact.lead = leads_1.lead_id
      WHERE event_type IN ('INVITE_SENT', 'ACCEPTED', 'REPLY_RECEIVED') GROUP BY segment""",
    "dq_completeness": _checks(
        [complete(*r) for r in REQUIRED]
        + [complete("raw_events", "raw_events", {"id": "id", "agent_id": "agent_id", "event_type": "event_type", "status": "status"})]
    ),
    "dq_uniqueness": _checks(
        [unique(*u) for u in UNIQUE]
        + [unique("raw_events", "raw_events", "id"), unique("lineitem", "lineitem", "(l_orderkey, l_linenumber)")]
    ),
    "dq_validity_type": _checks([VALID_TYPE]),
    "dq_validity_tier": _checks([VALID_TIER]),
    "dq_timeliness": _checks([timely(AS_OF)]),
    "dq_referential": _checks(
        [refers(*r) for r in REFERS]
        + [
            refers("orders", "o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
            refers("orders", "date_key", "orders", "cast(strftime(o_orderdate, '%Y%m%d') AS INTEGER)", "calendar", "date_key"),
            refers("events", "agent_id", "valid_events", "agent_id", "agents_1", "agent_id"),
            refers("events", "lead_id", "valid_events", "lead_id", "leads_1", "lead_id"),
            refers("events", "campaign_id", "valid_events", "campaign_id", "campaigns_1", "campaign_id"),
            refers("events", "template_id", "valid_events", "template_id", "templates", "template_id"),
        ]
    ),
    "dq_referential_empty": """SELECT 'referential_integrity' AS check_dimension, unnest(['fact_outreach_event.agent_key', 'fact_outreach_event.lead_key',
      'fact_outreach_event.campaign_key', 'fact_outreach_event.date_key', 'fact_daily_agent_activity.agent_key', 'fact_daily_agent_activity.date_key',
      'fact_campaign_performance.campaign_key']) AS table_name, 100.0::DOUBLE AS score, '{"total_fks":0,"orphans":0}' AS details""",
    "dq_composite": "SELECT composite_score, composite_score >= 85 AS passed FROM dq_total",
    "dq_history": f"""SELECT 'run_1' AS run_id, check_dimension, table_name, round(score, 6) AS score, cast(weight AS DOUBLE) AS weight, '{AS_OF}' AS checked_at,
      (SELECT composite_score FROM dq_total) AS composite_score, (SELECT composite_score >= 85 FROM dq_total) AS passed
      FROM dq_checks JOIN weights USING (check_dimension)""",
    "stored_dq_history": f"""SELECT run_id, check_dimension, table_name, round(score, 6) AS score, cast(weight AS DOUBLE) AS weight, '{AS_OF}' AS checked_at,
      (SELECT composite_score FROM dq_total) AS composite_score, (SELECT composite_score >= 85 FROM dq_total) AS passed
      FROM dq_checks JOIN weights USING (check_dimension), (VALUES ('run_1'), ('run_2')) AS r(run_id)""",
    "dq_trend": "SELECT checked_at, composite_score FROM dq_runs",
    "dq_latest": """SELECT checked_at, composite_score, CASE WHEN composite_score >= 97 THEN 'Pass' ELSE 'Fail' END AS label FROM dq_runs
      WHERE checked_at = (SELECT max(checked_at) FROM dq_runs)""",
    "anomaly_history": f"SELECT agent_id, {SCORED}, is_latest FROM points",
    "anomaly_latest": f"SELECT agent_id, {SCORED} FROM points WHERE is_latest",
    "rate_collapse": f"""SELECT campaign_id, date_key, round(v, 9) AS current_value, {known('z')} AS z_score, {known('q1')} AS iqr_lower, {known('q3')} AS iqr_upper,
      anomaly_score, method_triggered FROM ({scored("(SELECT campaign_id, date_key, conversion_rate AS v FROM performance WHERE conversion_rate IS NOT NULL)", "campaign_id", "TRUE")})""",
    "ghosting": f"""SELECT agent_id, date_key, round(v, 9) AS current_value, CASE WHEN prior >= 5 THEN n ELSE 0 END AS baseline_points, {known('z')} AS z_score,
      anomaly_score, method_triggered FROM ({scored("(SELECT agent_id, date_key, v FROM series WHERE metric = 'ghosting_rate')", "agent_id", "FALSE", "UNBOUNDED PRECEDING")})""",
    "risk_scores": """SELECT agent_id, display_name, tier_name, risk_score, risk_level, recommended_daily_invites, recommended_daily_messages, justification FROM advice""",
    "risk_scores_across_versions": """SELECT agent_id, coalesce(risk_score, 0) AS risk_score,
      CASE WHEN coalesce(risk_score, 0) <= 30 THEN 'Green' WHEN risk_score <= 60 THEN 'Amber' ELSE 'Red' END AS risk_level
      FROM (SELECT agent_id FROM agent_versions WHERE is_current) LEFT JOIN agent_risks USING (agent_id)""",
    "risk_latest_writeback": "SELECT agent_id, date_key, round(anomaly_score, 6) AS anomaly_score FROM scored_days",
    "platform_risk": """SELECT round(s, 6) AS platform_average_risk_score, CASE WHEN s <= 30 THEN 'Low Risk' WHEN s <= 60 THEN 'Moderate Risk' ELSE 'High Risk' END
      AS risk_level_label FROM (SELECT avg(anomaly_score) * 50 AS s FROM scored_days)""",
    "recommended_capacity": f"""SELECT *, round({ratio('recommended_invites', 'daily_invite_limit')} - 1, 6) AS capacity_adjustment_pct FROM (
      SELECT a.agent_id, (SELECT max(date_key) FROM activity) AS date_key, round(anomaly_score * 50, 6) AS agent_risk_score, daily_invite_limit,
        CASE WHEN coalesce(anomaly_score, 0) * 50 <= 30 THEN cast(daily_invite_limit AS DOUBLE)
          WHEN anomaly_score * 50 <= 60 THEN round(daily_invite_limit * 0.8) ELSE round(daily_invite_limit * 0.5) END AS recommended_invites
      FROM agents_1 a LEFT JOIN tiers ON a.tier_name = tiers.tier_name
        LEFT JOIN (SELECT * FROM scored_days WHERE date_key = (SELECT max(date_key) FROM activity)) s ON a.agent_id = s.agent_id)""",
    "alerts_high_risk": """SELECT concat('🔴 High Risk Agent: ', agent_id) AS title,
      concat('Agent `', agent_id, '` risk score: **', cast(risk_score AS VARCHAR), '** (', risk_level, ').', chr(10), chr(10), justification) AS message,
      CASE risk_level WHEN 'Red' THEN 'CRITICAL' ELSE 'WARNING' END AS level, cast(risk_score AS VARCHAR) AS risk_score
      FROM advice WHERE risk_level <> 'Green'""",
    "alerts_duration": """SELECT '⏱️ Anomalous Pipeline Duration' AS title, 'WARNING' AS level, run_id, round(z, 6) AS z_score FROM slow WHERE round(z, 9) > 2""",
    "alerts_failed_runs": """SELECT '🚨 Pipeline Failure' AS title, concat('Pipeline run `', run_id, '` failed after ', cast(round(cast(duration_seconds AS DECIMAL(18, 2)), 1) AS VARCHAR), 's.', chr(10), chr(10),
      'Error: source unreachable') AS message, 'CRITICAL' AS level FROM runs WHERE status = 'FAILED'""",
}
STEPS["mixed"] = f"""SELECT pos, coalesce({text('id')}, concat('lead_', substr(md5(nullif(trim(coalesce(nullif(linkedin_url, ''),
    CASE WHEN concat(first_name, last_name) <> '' THEN concat(coalesce(first_name, ''), '_', coalesce(last_name, '')) END)), '')), 1, 10))) AS lead_id0,
    CASE WHEN {text('id')} IS NULL AND nullif(trim(linkedin_url), '') IS NULL AND coalesce(concat(first_name, last_name), '') = '' THEN NULL ELSE lead_id0 END AS lead_id,
    coalesce({text('name', 255)}, nullif(trim(concat_ws(' ', first_name, last_name)), ''), 'Unknown Prospect') AS full_name,
    {text('company', 255, 'Unknown Company')} AS company, 'Professional' AS title, {text('linkedin_url', 500)} AS linkedin_url,
    {text('list_name', 100, 'Target Prospects')} AS segment, {text('status', 50, 'NEW')} AS lead_status FROM raw_leads_mixed"""
SELECTS["clean_leads"] = SELECTS["clean_leads"].replace("EXCLUDE (pos)", "EXCLUDE (pos, lead_id0)")
for _n in ("1", "2"):
    STEPS[f"days_{_n}"] = f"""SELECT *, {rate('invites_accepted', 'invites_sent')} AS acceptance_rate, {rate('replies_received', 'invites_accepted')} AS reply_rate
      FROM (SELECT agent_id, date_key, {counts()} FROM batch_{_n} WHERE agent_id IS NOT NULL GROUP BY agent_id, date_key)"""
_dims = union([
    complete("fact_outreach_event", "fact", {"event_type": "event_type", "lead_key": "lead"}), VALID_TYPE
])
SELECTS["alerts_dq"] = "SELECT '⚠️ Data Quality Breach' AS title, 'WARNING' AS level, run_id, dimension_scores FROM (" + union([
    f"""SELECT run_id, composite_score, concat('{{', string_agg(concat('"', check_dimension, '":', cast(round(s, 2) AS VARCHAR)), ',' ORDER BY check_dimension), '}}') AS dimension_scores
    FROM dq_runs, (SELECT check_dimension, avg(score) AS s FROM ({_dims} UNION ALL {timely(at)}) GROUP BY check_dimension)
    WHERE run_id = '{run}' GROUP BY run_id, composite_score"""
    for run, at in (("run_1", AS_OF), ("run_2", "2024-01-31 00:00:00"))
]) + ") WHERE composite_score < 97"

# ── Sources, streams and the batch run ────────────────────────────────────────

CONNECTED_DAY = "DATE '2024-01-01' + cast(c_custkey % 300 AS INTEGER)"
STEPS["connected"] = f"""SELECT *, concat('real_lead_', substr(md5(linkedin_url), 1, 10)) AS lead_id FROM (
    SELECT c_custkey, c_nationkey, coalesce(CASE WHEN c_acctbal > 5000 THEN concat('https://example.test/in/', cast(c_custkey AS VARCHAR)) END,
      concat('https://linkedin.com/in/', lower(f), '-', lower(l))) AS linkedin_url, trim(concat(f, ' ', l)) AS full_name,
      concat(c_mktsegment, ', Inc.') AS company, CASE WHEN c_nationkey < 12 THEN 'Professional' ELSE 'Buyer' END AS title, {CONNECTED_DAY} AS d
    FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN '' ELSE 'Cust' END AS f, CASE WHEN c_acctbal < -500 THEN '' ELSE c_name END AS l FROM customer)
    WHERE f <> '' OR l <> '')"""
STEPS["invited"] = """SELECT DISTINCT s_name, TIMESTAMP '2024-03-01 14:05:09' + to_days(cast(s_suppkey % 60 AS INTEGER)) AS t FROM supplier WHERE s_acctbal >= 2000"""
STEPS["crm_rows"] = """
    SELECT o_orderkey AS pos, 'lead_c' || cast(c_custkey AS VARCHAR) AS lead_id, c_name AS full_name,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'Buyer' END AS title, CASE WHEN o_totalprice > 250000 THEN concat('Firm, ', c_mktsegment) END AS company,
      CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE concat('Town ', cast(c_nationkey AS VARCHAR)) END AS segment,
      CASE o_orderstatus WHEN 'F' THEN 'CONNECTED' WHEN 'O' THEN 'INVITE_SENT' ELSE 'ENRICHED' END AS lead_status,
      CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 570 MINUTE END AS sent,
      CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 18 HOUR + INTERVAL 45 MINUTE + INTERVAL 30 SECOND END AS accepted
    FROM orders JOIN customer ON o_custkey = c_custkey
    UNION ALL
    SELECT 1000000000000 + s_suppkey, concat('lead_', lower(replace(s_name, '#', '_'))), s_name, 'Seller', NULL, 'General',
      CASE WHEN s_acctbal < 0 THEN 'CONNECTED' ELSE 'CAPTURED' END, NULL, NULL FROM supplier"""
STEPS["live_valid"] = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_source_id ORDER BY pos) AS rn FROM all_typed
    WHERE event_source_id IS NOT NULL AND event_type IS NOT NULL AND event_timestamp IS NOT NULL) WHERE rn = 1"""
STEPS["live_days"] = f"""SELECT *, {rate('invites_accepted', 'invites_sent')} AS acceptance_rate, {rate('replies_received', 'invites_accepted')} AS reply_rate
    FROM (SELECT agent_id, date_key, {counts()} FROM live_valid JOIN agents_1 USING (agent_id) GROUP BY agent_id, date_key)"""
STEPS["all_judged"] = """SELECT *, CASE WHEN event_source_id IS NULL THEN 'missing_event_id' WHEN event_type IS NULL THEN 'missing_event_type'
    WHEN event_timestamp IS NULL THEN 'bad_timestamp' END AS rule FROM all_typed"""
WEBHOOK_JSON = """concat('{"account_id":"acc_', role, '","contact_id":"lead_', cast(conv_id AS VARCHAR), '",',
    CASE WHEN role = 'user' THEN '"action":"reply",' ELSE '' END, '"created_at":"', moment, '"}')"""

SELECTS |= {
    "entity_files": "SELECT * FROM leads_1 UNION ALL SELECT * FROM leads_2 WHERE lead_id NOT IN (SELECT lead_id FROM leads_1)",
    "epoch_event_times": f"""SELECT cast(event_id AS VARCHAR) AS event_source_id, CASE WHEN event_type <> 'view' THEN {stamp('ts')} END AS event_timestamp,
      CASE WHEN event_type = 'view' THEN 'bad_timestamp' END AS rule FROM events""",
    "paged_leads": """SELECT cast(c_custkey AS VARCHAR) AS lead_id, c_name AS full_name, c_mktsegment AS segment FROM customer
      UNION ALL SELECT concat('s', cast(s_suppkey AS VARCHAR)), s_name, 'Suppliers' FROM supplier""",
    "paged_pages_gap": """SELECT concat('c', cast(max(c_custkey) // 50 + 1 AS VARCHAR)) AS cursor FROM customer
      UNION ALL SELECT concat('s', cast(max(s_suppkey) // 50 + 1 AS VARCHAR)) FROM supplier""",
    "incremental_orders": "SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-01' GROUP BY o_orderstatus",
    "watermark_upsert": f"""SELECT event_type AS entity_name, {stamp('max(ts)')} AS last_synced_at, CASE WHEN max(ts) = min(ts) THEN 'skip' ELSE 'update' END AS action
      FROM events GROUP BY event_type UNION ALL SELECT 'orders', {stamp('max(o_orderdate)')}, 'insert' FROM orders""",
    "raw_landing": """SELECT nullif(id, '') AS source_id, 'csv' AS source_type, FALSE AS processed, 'run_1' AS run_id, event_type AS payload_type FROM raw_events""",
    "archive_leads": f"""SELECT lead_id, linkedin_url, full_name, company, title, strftime(d, '%Y-%m-%d 00:00:00') AS connected_at,
      '1st Degree Connections' AS segment, 'CONNECTED' AS lead_status
      FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY c_nationkey, c_custkey) AS rn FROM connected) WHERE rn = 1""",
    "archive_events": f"""SELECT concat('evt_conn_', lead_id) AS event_source_id, 'my_live_account' AS agent_id, lead_id, 'camp_personal_network' AS campaign_id,
      'ACCEPTED' AS event_type, strftime(d, '%Y-%m-%d 00:00:00') AS event_timestamp, cast(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, 'SUCCESS' AS event_status
      FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY c_nationkey, c_custkey) AS rn FROM connected) WHERE rn = 1
      UNION ALL SELECT concat('evt_inv_', substr(md5(concat(s_name, {stamp('t')})), 1, 10)), 'my_live_account', NULL, 'camp_personal_network',
      'INVITE_SENT', {stamp('t')}, cast(strftime(t, '%Y%m%d') AS INTEGER), 'SUCCESS' FROM invited""",
    "crm_leads": f"""SELECT lead_id, full_name, company, title, CASE WHEN fresh THEN segment ELSE 'Old' END AS segment, lead_status,
      CASE WHEN fresh THEN '{RELOADED}' ELSE '{LOADED}' END AS valid_from, CASE WHEN fresh THEN 'insert' ELSE 'update' END AS action
      FROM (SELECT lead_id, arg_min(full_name, pos) AS full_name, coalesce(arg_min(company, pos) FILTER (WHERE company IS NOT NULL), 'Confidential') AS company,
        coalesce(arg_min(title, pos) FILTER (WHERE title IS NOT NULL), 'Recruiter') AS title, arg_min(segment, pos) AS segment,
        arg_max(lead_status, pos) AS lead_status, max(pos) < 1000000000000 AS fresh FROM crm_rows GROUP BY lead_id)""",
    "crm_events": f"""SELECT concat('evt_sent_', lead_id) AS event_source_id, 'agent_crm' AS agent_id, lead_id, 'camp_crm' AS campaign_id, 'INVITE_SENT' AS event_type,
        {stamp(f"coalesce(sent, TIMESTAMP '{AS_OF}')")} AS event_timestamp, cast(strftime(coalesce(sent, TIMESTAMP '{AS_OF}'), '%Y%m%d') AS INTEGER) AS date_key,
        'SUCCESS' AS event_status, cast(NULL AS INTEGER) AS response_time_minutes
      FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY pos) AS rn FROM crm_rows WHERE lead_status IN ('CONNECTED', 'INVITE_SENT')) WHERE rn = 1
      UNION ALL SELECT concat('evt_acc_', lead_id), 'agent_crm', lead_id, 'camp_crm', 'ACCEPTED', {stamp(f"coalesce(accepted, TIMESTAMP '{AS_OF}')")},
        cast(strftime(coalesce(accepted, TIMESTAMP '{AS_OF}'), '%Y%m%d') AS INTEGER), 'SUCCESS', CASE WHEN sent IS NOT NULL THEN 555 END
      FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY pos) AS rn FROM crm_rows WHERE lead_status = 'CONNECTED') WHERE rn = 1""",
    "stream_daily_activity": f"""SELECT d.*, {rate('invites_sent', 'daily_invite_limit')} AS utilisation_pct
      FROM live_days d JOIN agents_1 USING (agent_id) LEFT JOIN tiers USING (tier_name)""",
    "stream_events": SELECTS["micro_batch_merge"].replace("SELECT * FROM", "SELECT event_source_id, event_type, event_timestamp, date_key, event_status, response_time_minutes FROM", 1),
    "stream_receipts": f"""SELECT CASE WHEN rule IS NULL THEN 'SUCCESS' ELSE 'DEAD_LETTERED' END AS status, coalesce(event_type, 'UNKNOWN') AS event_type,
      CASE WHEN rule IS NOT NULL THEN 'Event format failed validation and was routed to Dead-Letter Queue.' END AS warning, count(*) AS n FROM all_judged GROUP BY 1, 2, 3""",
    "stream_dead_letters": "SELECT rule AS error_type, 'transformer' AS source, FALSE AS resolved, count(*) AS n FROM all_judged WHERE rule IS NOT NULL GROUP BY rule",
    "stream_same_file_copies": SELECTS["micro_batch_merge"].replace("SELECT * FROM", "SELECT event_source_id, event_type, event_timestamp, date_key, event_status, response_time_minutes FROM", 1),
    "incremental_run": """SELECT 'run_1' AS run_id, 'SUCCESS' AS status, count(*) FILTER (WHERE o_orderdate <= DATE '1996-01-01') AS rows_extracted,
        count(*) FILTER (WHERE o_orderdate <= DATE '1996-01-01') AS rows_loaded FROM orders
      UNION ALL SELECT 'run_2', 'SUCCESS', count(*) FILTER (WHERE o_orderdate > DATE '1996-01-01'), count(*) FILTER (WHERE o_orderdate > DATE '1996-01-01') FROM orders
      UNION ALL SELECT 'run_3', 'FAILED', 0, 0""",
    "incremental_late_rows": """WITH w AS (SELECT max(o_orderdate) AS newest FROM orders WHERE o_orderdate <= DATE '1996-01-01' AND o_orderkey % 5 <> 0),
      o AS (SELECT o_orderstatus AS status, o_orderdate <= DATE '1996-01-01' AND o_orderkey % 5 <> 0 AS early,
        o_orderdate BETWEEN newest - INTERVAL 7 DAY AND DATE '1996-01-01' AND o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 AS changed,
        o_orderkey % 7 = 0 AND (o_orderkey % 5 = 0 OR o_orderdate > DATE '1996-01-01') AS untimed FROM orders, w)
      SELECT 'extracted' AS what, 'run_1' AS name, count(*) FILTER (WHERE early) AS n FROM o
      UNION ALL SELECT 'extracted', 'run_2', count(*) FILTER (WHERE NOT early OR changed) FROM o
      UNION ALL SELECT 'extracted', 'run_3', 0
      UNION ALL SELECT 'letter', 'run_2:missing_update_time', count(*) FROM o WHERE untimed HAVING count(*) > 0
      UNION ALL SELECT 'lead', concat(status, ':false'), count(*) FROM o WHERE changed GROUP BY status
      UNION ALL SELECT 'lead', concat(CASE WHEN changed THEN 'X' ELSE status END, ':true'), count(*) FROM o WHERE NOT untimed GROUP BY 2""",
    "replayed_bad_json": """SELECT cast(doc_id AS VARCHAR) AS number, 'leads' AS entity_name, 'bad_json' AS error_type, doc_id % 2 = 1 AS resolved,
        CASE WHEN doc_id % 2 = 1 THEN concat('Doc ', doc_id) END AS full_name FROM documents WHERE doc_id % 7 = 0""",
    "landed_states": """SELECT 'run_1' AS run_id, state, state <> 'dead_lettered' AS processed, event_type AS payload_type, count(*) AS n FROM (
        SELECT event_type, CASE WHEN copy > 1 THEN 'duplicate' WHEN nullif(id, '') IS NULL OR event_type IS NULL OR "timestamp" = 'not-a-date' THEN 'dead_lettered' ELSE 'processed' END AS state
        FROM (SELECT *, CASE WHEN nullif(id, '') IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY id ORDER BY pos) END AS copy FROM raw_events)) GROUP BY ALL""",
    "reprocessed_events": f"SELECT event_source_id, event_type, event_timestamp, date_key, event_status, response_time_minutes FROM ({SELECTS['clean_events']})",
    "alert_table": "SELECT 'run_3' AS run_id, '🚨 Pipeline Failure' AS title, 'CRITICAL' AS level",
    "dq_key_collisions": """SELECT 'dim_agent' AS table_name, (SELECT count(*) FROM agents_1) AS n_rows, 0::BIGINT AS collisions
      UNION ALL SELECT 'dim_lead', (SELECT count(*) FROM leads_1), 0 UNION ALL SELECT 'dim_campaign', (SELECT count(*) FROM campaigns_1), 0
      UNION ALL SELECT 'dim_message_template', (SELECT count(*) FROM templates), 0""",
    "event_sink_upsert": f"SELECT * EXCLUDE (action) FROM ({SELECTS['event_upsert']})",
    "live_lead_registration": "SELECT * EXCLUDE (act) FROM lead_versions",
    "landed_faults": """SELECT error_type, record_payload, count(*) AS n FROM (
        SELECT CASE WHEN doc_id % 7 = 0 THEN 'bad_json' ELSE 'missing_lead_id' END AS error_type,
          CASE WHEN doc_id % 7 = 0 THEN substr(concat('{"lead_id": "d', doc_id), 1, 15)
            ELSE concat('{"Score": ', n_chars, ', "source": "', source, '"}') END AS record_payload
        FROM documents WHERE n_chars IS NOT NULL AND source IS NOT NULL AND (doc_id % 7 = 0 OR doc_id % 3 = 0)) GROUP BY ALL""",
    "stream_load_rejects": """SELECT source, error_type, error_message, count(*) AS n FROM (
        SELECT 'loader' AS source, 'too_long' AS error_type, 'event_source_id is longer than 200' AS error_message FROM documents
          WHERE length(text) + length(cast(doc_id AS VARCHAR)) + 5 > 200
        UNION ALL SELECT 'transformer', 'missing_event_id', 'Missing event_id' FROM documents WHERE text IS NULL
        UNION ALL SELECT 'transformer', 'bad_timestamp', 'Missing or unparseable timestamp' FROM conversations WHERE role IS DISTINCT FROM 'user') GROUP BY ALL""",
    "stream_two_sources": f"""SELECT status, event_type, count(*) AS n FROM (
        SELECT CASE WHEN text IS NULL OR length(text) + length(cast(doc_id AS VARCHAR)) + 5 > 200 THEN 'DEAD_LETTERED' ELSE 'SUCCESS' END AS status,
          'INVITE_SENT' AS event_type FROM documents
        UNION ALL SELECT CASE WHEN role = 'user' THEN 'SUCCESS' ELSE 'DEAD_LETTERED' END, CASE WHEN role = 'user' THEN 'REPLY_RECEIVED' ELSE 'MESSAGE_SENT' END
          FROM conversations
        UNION ALL SELECT 'STORED', 'INVITE_SENT' FROM documents WHERE length(text) + length(cast(doc_id AS VARCHAR)) + 5 <= 200
        UNION ALL SELECT 'STORED', 'REPLY_RECEIVED' FROM (SELECT DISTINCT conv_id, turn % 60 FROM conversations WHERE role = 'user')) GROUP BY ALL""",
    "replayed_duplicates": """SELECT event_source_id, run_id, run_id <> 'run_1' AS resolved FROM judged,
      (SELECT unnest(['run_1', 'run_2', 'loaded']) AS run_id) WHERE rule = 'bad_timestamp'""",
    "replayed_loader_rejects": """SELECT concat('lead_d', cast(doc_id AS VARCHAR)) AS source_id, 'loader' AS source, TRUE AS resolved,
      concat(lang, ' Cut') AS full_name FROM documents WHERE length(concat(lang, ' ', text)) > 255""",
    "webhook_events": f"""SELECT concat('wh_', substr(md5({WEBHOOK_JSON}), 1, 10)) AS event_source_id, concat('acc_', role) AS agent_id,
      concat('lead_', cast(conv_id AS VARCHAR)) AS lead_id, cast(NULL AS VARCHAR) AS campaign_id, cast(NULL AS VARCHAR) AS template_id,
      CASE WHEN role = 'user' THEN 'REPLY_RECEIVED' ELSE 'MESSAGE_SENT' END AS event_type, {stamp('cast(moment AS TIMESTAMP)')} AS event_timestamp,
      'SUCCESS' AS event_status, cast(NULL AS INTEGER) AS response_time_minutes, 20240201 AS date_key
      FROM (SELECT DISTINCT conv_id, role, concat('2024-02-01T00:', lpad(cast(turn % 60 AS VARCHAR), 2, '0'), ':00Z') AS moment FROM conversations)""",
    "windowed_stream_activity": """SELECT strftime(d, '%Y-%m-%d') AS day, agent_id, count(*) FILTER (WHERE event_type = 'view') AS invites_sent,
      count(*) FILTER (WHERE event_type = 'click') AS invites_accepted, 0::BIGINT AS messages_sent, 0::BIGINT AS replies_received,
      count(*) FILTER (WHERE event_type = 'purchase') AS meetings_booked
      FROM (SELECT *, cast(ts AS DATE) AS d, concat('agent_', cast(cast(floor(user_id / 50) AS BIGINT) AS VARCHAR)) AS agent_id FROM events)
      WHERE d + 1 <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY GROUP BY d, agent_id""",
    "batch_run_audit": f"""SELECT 'run_1' AS run_id, e.n + a.n + l.n + c.n + t.n AS rows_extracted, f.n + a.n + l.n + d.n + m.n AS rows_loaded, 0::BIGINT AS rows_failed,
      'PARTIAL' AS status, dq_score, dq_score >= 85 AS dq_passed
      FROM (SELECT count(*) AS n FROM raw_events) e, (SELECT count(*) AS n FROM raw_agents_1) a, (SELECT count(*) AS n FROM raw_leads_1) l,
        (SELECT count(*) AS n FROM raw_campaigns_1) c, (SELECT count(*) AS n FROM raw_templates) t, (SELECT count(*) AS n FROM fact) f,
        (SELECT count(*) AS n FROM campaigns_1) d, (SELECT count(*) AS n FROM templates) m,
        (SELECT round(sum(CASE WHEN check_dimension = 'timeliness' THEN 100 ELSE dimension_score END * weight), 2) AS dq_score FROM weights JOIN dq_scores USING (check_dimension))""",
}


def statements() -> dict[str, str]:
    return {name: _with(select) for name, select in SELECTS.items()}
