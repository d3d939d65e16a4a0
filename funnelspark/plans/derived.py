"""Raw outreach entities derived from the test tables.

The SQL texts run unchanged on Spark and on DuckDB, so both sides of a comparison start from the same rows.
They read whole tables; the faults (missing ids, odd spellings, repeats) are made from column values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from funnelspark.session import prepare

# Fifty users share an agent account and six neighbouring events a lead, so both grow with the data. On the
# last day every third agent floods invites and is accepted by nobody, and its neighbour gets no replies.
RAW_EVENTS = """
SELECT event_id AS pos,
  CASE WHEN event_id % 103 = 0 THEN '' ELSE concat('evt_', cast(event_id AS string)) END AS id,
  CASE WHEN event_id % 71 = 0 THEN NULL ELSE concat('agent_', cast(n AS string)) END AS agent_id,
  concat('lead_', cast(cast(floor(event_id / 6) AS bigint) AS string)) AS lead_id,
  CASE WHEN event_id % 11 = 0 THEN 'camp_unlisted'
       ELSE concat('camp_', regexp_extract(props, '([0-9]+)', 1)) END AS campaign_id,
  concat('tmpl_', cast(event_id % 6 AS string)) AS template_id,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'Profile-Viewed'
       WHEN last_day AND n % 3 = 1 AND event_type IN ('error', 'purchase') THEN 'sent'
       WHEN last_day AND n % 3 = 1 AND event_type IN ('click', 'signup') THEN 'Withdrawn'
       WHEN last_day AND n % 3 = 2 AND event_type = 'signup' THEN 'Invite Sent'
       WHEN event_type = 'view' THEN ' invitation-sent ' WHEN event_type = 'click' THEN 'Connected'
       WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'Message' WHEN event_type = 'signup' THEN 'replied'
       WHEN event_type = 'purchase' THEN 'Meeting Booked' ELSE 'error' END AS event_type,
  CASE WHEN event_id % 97 = 0 THEN 'not-a-date' WHEN event_id % 3 = 0 THEN moment
       ELSE concat(replace(moment, ' ', 'T'), 'Z') END AS timestamp,
  CASE WHEN event_type = 'error' THEN 'FAILED' END AS status,
  CASE WHEN event_type = 'signup' AND event_id % 2 = 1 THEN cast(value AS string) END AS response_time_minutes
FROM (SELECT event_id, event_type, value, props, cast(floor(user_id / 50) AS bigint) AS n,
        substr(cast(ts AS string), 1, 19) AS moment, substr(cast(ts AS string), 1, 10) = '2024-01-30' AS last_day FROM {events}) e
UNION ALL
SELECT event_id + 1000000000000, concat('evt_', cast(event_id AS string)), 'agent_late', 'lead_0', 'camp_0', 'tmpl_0',
  'reply', '2024-01-31T08:00:00Z', 'DUP', '7.9'
FROM {events} WHERE event_type = 'purchase'
"""

RAW_AGENTS_1 = """
SELECT n AS pos, concat('agent_', cast(n AS string)) AS id, concat('Agent ', cast(n AS string)) AS name,
  concat('a', cast(n AS string), '@example.test') AS email,
  CASE n % 5 WHEN 1 THEN 'paused' WHEN 2 THEN 'ghost' END AS status,
  CASE n % 6 WHEN 0 THEN '< 1 Month' WHEN 1 THEN '1 Month' WHEN 2 THEN '2-6 Months'
       WHEN 3 THEN '6-12 Months' WHEN 4 THEN '1+ Year' ELSE 'n/a' END AS account_age
FROM (SELECT DISTINCT cast(floor(user_id / 50) AS bigint) AS n FROM {events}) e
UNION ALL
SELECT 1000000000000 + r_regionkey, concat('agent_r', cast(r_regionkey AS string)), r_name, NULL, 'active', '1+ Year' FROM {region}
"""

RAW_AGENTS_2 = """
SELECT n AS pos, concat('agent_', cast(n AS string)) AS id, concat('Agent No. ', cast(n AS string)) AS name,
  concat('a', cast(n AS string), '@example.test') AS email,
  CASE WHEN n % 4 = 3 THEN 'paused' WHEN n % 5 = 1 THEN 'paused' WHEN n % 5 = 2 THEN 'ghost' END AS status,
  CASE n % 6 WHEN 0 THEN '< 1 Month' WHEN 1 THEN '2-6 Months' WHEN 2 THEN '2-6 Months'
       WHEN 3 THEN '6-12 Months' WHEN 4 THEN '1+ Year' ELSE 'n/a' END AS account_age
FROM (SELECT DISTINCT cast(floor(user_id / 50) AS bigint) AS n FROM {events}) e
UNION ALL
SELECT 1000000000000 + n_nationkey, concat('agent_n', cast(n_nationkey AS string)), n_name, NULL, ' active ', '1 Month' FROM {nation}
"""

RAW_LEADS_1 = """
SELECT c_custkey AS pos, concat('lead_', cast(c_custkey AS string)) AS id, c_name AS name, n_name AS company,
  c_mktsegment AS segment, CASE WHEN c_acctbal < 0 THEN 'new' ELSE 'contacted' END AS status
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT 1000000000000 + n_nationkey, concat('lead_n', cast(n_nationkey AS string)), n_name, NULL, NULL, NULL FROM {nation}
"""

RAW_LEADS_2 = """
SELECT c_custkey AS pos, concat('lead_', cast(c_custkey AS string)) AS id, lower(c_name) AS name, n_name AS company,
  CASE WHEN c_acctbal > 8000 THEN 'MOVED' ELSE c_mktsegment END AS segment,
  CASE WHEN c_acctbal < 500 THEN NULL ELSE 'contacted' END AS status
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT 1000000000000 + s_suppkey, concat('lead_s', cast(s_suppkey AS string)), s_name, NULL, 'null', NULL FROM {supplier}
"""

# Leads without an id, with only an address, only a name, or nothing at all.
RAW_LEADS_MIXED = """
SELECT c_custkey AS pos, concat(' lead_', cast(c_custkey AS string)) AS id, cast(NULL AS string) AS name,
  'Ann' AS first_name, c_name AS last_name, n_name AS company, CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_mktsegment END AS list_name,
  cast(NULL AS string) AS linkedin_url, CASE WHEN c_acctbal > 5000 THEN 'warm' END AS status
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT 1000000000000 + s_suppkey, CASE WHEN s_acctbal < 0 THEN 'null' END, NULL, CASE WHEN s_acctbal < 5000 THEN 'Sup' END, s_name,
  NULL, 'Suppliers', CASE WHEN s_nationkey < 12 THEN concat(' https://example.test/in/', s_name, ' ') END, 'captured'
FROM {supplier}
UNION ALL
SELECT 2000000000000 + c_custkey, concat('lead_', cast(c_custkey AS string)), 'Second copy', NULL, NULL, NULL, NULL, NULL, NULL
FROM {customer}
UNION ALL
SELECT 3000000000000 + n_nationkey, '   ', n_name, NULL, NULL, 'Nowhere', NULL, '', NULL FROM {nation}
"""

RAW_CAMPAIGNS_1 = """
SELECT p_partkey AS pos, concat('camp_', cast(p_partkey AS string)) AS id, p_name AS name, p_type AS type, p_brand AS segment,
  CASE WHEN p_size > 40 THEN 'soon' WHEN p_size > 20 THEN '2023-12-1' ELSE '2023-12-01T06:30:00+05:30' END AS created_at
FROM {part}
UNION ALL
SELECT 1000000000000 + r_regionkey, CASE WHEN r_regionkey > 2 THEN '' ELSE concat('camp_', cast(r_regionkey AS string)) END,
  r_name, 'REGION', NULL, NULL FROM {region}
"""

RAW_CAMPAIGNS_2 = """
SELECT p_partkey AS pos, concat('camp_', cast(p_partkey AS string)) AS id, CASE WHEN p_retailprice > 950 THEN upper(p_name) ELSE p_name END AS name,
  p_type AS type, CASE WHEN p_size < 5 THEN NULL ELSE p_brand END AS segment, '2024-02-01' AS created_at
FROM {part}
UNION ALL
SELECT 1000000000000 + n_nationkey, concat('camp_n', cast(n_nationkey AS string)), n_name, 'NATION', NULL, '2024-02-01' FROM {nation}
"""

RAW_TEMPLATES = """
SELECT item_id AS pos, concat('tmpl_', cast(item_id AS string)) AS id, concat('Template ', cast(item_id AS string)) AS name,
  text AS body, CASE WHEN length(text) > 200 THEN 'email' ELSE ' message ' END AS channel
FROM {benchmark}
UNION ALL
SELECT 1000000000000 + r_regionkey, NULL, r_name, concat('Hi from ', r_name), 'email' FROM {region}
"""

# One run per order day and priority, the priority standing for the pipeline that ran.
PIPELINE_RUNS = """
SELECT o_orderpriority AS pipeline, concat('run_', substr(cast(o_orderdate AS string), 1, 10), '_', substr(o_orderpriority, 1, 1)) AS run_id,
  cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS duration_seconds, count(*) AS rows_extracted,
  CASE WHEN min(o_orderstatus) = 'P' THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM {orders} GROUP BY o_orderpriority, substr(cast(o_orderdate AS string), 1, 10)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the texts above with its ``{table}`` names bound to the parquet tables."""
    prepare(spark)
    names = {part.split("}")[0] for part in sql.split("{")[1:]}
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def for_duckdb(sql: str) -> str:
    """The same text with plain table names."""
    return sql.replace("{", "").replace("}", "").strip()
