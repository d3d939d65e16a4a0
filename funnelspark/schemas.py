"""Declared schemas: raw entities (all text, every accepted field name) and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Accepted source field names per entity. Matching is case-sensitive.
RAW_FIELDS = {
    "agents": ["id", "agent_id", "email", "linkedin_email", "name", "display_name", "status", "account_age", "tier"],
    "leads": [
        "id", "lead_id", "linkedin_url", "profile_url", "Profile URL", "URL", "first_name", "last_name",
        "name", "full_name", "company", "organization", "title", "job_title", "Position",
        "segment", "list_name", "location", "status", "lead_status",
    ],
    "campaigns": [
        "id", "campaign_id", "name", "campaign_name", "type", "campaign_type", "segment", "target_segment", "created_at",
    ],
    "events": [
        "id", "event_id", "agent_id", "lead_id", "campaign_id", "template_id", "event_type", "type", "action",
        "timestamp", "event_timestamp", "created_at", "date", "status", "response_time_minutes",
    ],
    "templates": ["id", "template_id", "name", "template_name", "body", "template_body", "channel", "created_at"],
    "webhooks": [
        "id", "event_id", "agent_id", "account_id", "lead_id", "contact_id", "campaign_id", "event_type", "type",
        "action", "timestamp", "created_at", "status", "response_time_minutes",
    ],
}

# Fields whose JSON numbers are epoch seconds while their JSON texts are not.
TIME_FIELDS = {"timestamp", "event_timestamp", "created_at", "date"}

# Optional columns of raw rows: the record's own text where it has fields that are not declared, and the text of a record that is no JSON.
RECORD, CORRUPT = "_record", "_corrupt"

# Columns that order raw rows the way they lie in their sources: file kind, file, block, row.
POSITION = ["_src_rank", "_file", "_block", "_row"]


def raw_schema(entity: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in RAW_FIELDS[entity]])


def conform(df: DataFrame, entity: str, keep: list[str] = ()) -> DataFrame:
    """The entity's raw fields as text (missing ones NULL), the record's text if it comes along, and the columns to ``keep``."""
    have = set(df.columns)
    fields = [
        (F.col(f"`{name}`").cast("string") if name in have else F.lit(None).cast("string")).alias(name)
        for name in RAW_FIELDS[entity]
    ]
    return df.select(*fields, *carried(df, keep), *keep)


def carried(df: DataFrame, besides: list[str] = ()) -> list[str]:
    """Which of the optional columns a frame of raw rows has."""
    return [c for c in (RECORD, CORRUPT) if c in df.columns and c not in besides]


TABLES = {
    "dim_account_tier": "tier_key int, tier_name string, risk_classification string, "
                        "daily_invite_limit int, daily_message_limit int",
    "dim_agent": "agent_key bigint, agent_id string, linkedin_email string, display_name string, status string, "
                 "tier_key int, valid_from timestamp, valid_to timestamp, is_current boolean",
    "dim_lead": "lead_key bigint, lead_id string, full_name string, company string, title string, "
                "linkedin_url string, segment string, lead_status string, "
                "valid_from timestamp, valid_to timestamp, is_current boolean",
    "dim_campaign": "campaign_key bigint, campaign_id string, campaign_name string, campaign_type string, "
                    "target_segment string, created_at timestamp, updated_at timestamp",
    "dim_message_template": "template_key bigint, template_id string, template_name string, "
                            "template_body string, channel string, created_at timestamp",
    "fact_outreach_event": "event_key bigint, event_source_id string, agent_key bigint, lead_key bigint, "
                           "campaign_key bigint, date_key int, template_key bigint, event_type string, "
                           "event_timestamp timestamp, event_status string, response_time_minutes int, "
                           "loaded_at timestamp",
    "fact_daily_agent_activity": "agent_key bigint, date_key int, invites_sent bigint, invites_accepted bigint, "
                                 "messages_sent bigint, replies_received bigint, meetings_booked bigint, "
                                 "acceptance_rate double, reply_rate double, utilisation_pct double, "
                                 "anomaly_score double, loaded_at timestamp",
    "fact_campaign_performance": "campaign_key bigint, date_key int, total_leads bigint, invites_sent bigint, "
                                 "connected bigint, replied bigint, meetings_booked bigint, "
                                 "conversion_rate double, roi_score double, loaded_at timestamp",
    "fact_pipeline_run": "run_id string, correlation_id string, start_time timestamp, end_time timestamp, "
                         "duration_seconds double, rows_extracted bigint, rows_loaded bigint, rows_failed bigint, "
                         "rows_skipped bigint, status string, error_message string, dq_score double, dq_passed boolean",
    "pipeline_watermarks": "entity_name string, last_synced_at timestamp, last_record_id string, updated_at timestamp",
    "pipeline_synced": "entity_name string, record_key string, synced_at timestamp",
    "dead_letter_queue": "source_id string, record_payload string, error_message string, error_type string, "
                         "source string, run_id string, created_at timestamp, resolved boolean, resolved_at timestamp, entity_name string",
    "dq_results": "run_id string, check_dimension string, table_name string, score double, weight double, "
                  "details string, checked_at timestamp, composite_score double, passed boolean",
    "alerts": "title string, message string, level string, details map<string, string>, run_id string, raised_at timestamp",
    "live_receipts": "event_id string, event_type string, status string, warning string, persisted_at timestamp, run_id string",
    "stg_raw_events": "source_id string, source_type string, raw_payload string, received_at timestamp, "
                      "processed boolean, run_id string, position string, state string",
}


def table_schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def shape(df: DataFrame, table: str) -> DataFrame:
    """Exactly the table's columns and types; absent columns are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table_schema(table).fields
        ]
    )
