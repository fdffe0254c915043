"""Fixed schemas: the change event on the wire, and the platform's tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Fixed values.
OPS = ("c", "u", "d", "r")  # create, update, delete, snapshot read
SCHEMA_VERSION = 1

# The wire schema of a change event. Key and images stay JSON text.
EVENT = (
    "event_id STRING, op STRING, key STRING, before STRING, after STRING, "
    "source STRUCT<system: STRING, database: STRING, table: STRING, position: STRING, commit_ts: STRING, sequence: STRING>, "
    "captured_at STRING, trace_id STRING, schema_version INT, payload_hash STRING"
)

# A message of a topic.
MESSAGE = "key STRING, value STRING, headers MAP<STRING, STRING>, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"

# The platform's tables.
TABLES = {
    "cdc_control": "source_name STRING, watermark STRING, last_trace_id STRING, events_captured BIGINT, rejects BIGINT, status STRING, updated_at TIMESTAMP",
    "cdc_file_manifest": "file_name STRING, etag STRING, size BIGINT, sha256 STRING, rows BIGINT, rejected BIGINT, trace_id STRING, processed_at TIMESTAMP",
    "cdc_event_audit": "event_id STRING, source_name STRING, source_table STRING, op STRING, source_position STRING, source_commit_ts TIMESTAMP, payload_hash STRING, topic STRING, kafka_partition INT, kafka_offset BIGINT, trace_id STRING, produced_at TIMESTAMP",
    "bronze_change_events": "event_id STRING, op STRING, source_system STRING, source_database STRING, source_table STRING, source_position STRING, source_sequence STRING, source_commit_ts TIMESTAMP, key_json STRING, before_json STRING, after_json STRING, payload_hash STRING, captured_at TIMESTAMP, trace_id STRING, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, kafka_ts TIMESTAMP, ingested_at TIMESTAMP",
    "dq_reconciliation": "run_id STRING, checked_at TIMESTAMP, source_name STRING, table_name STRING, check_name STRING, source_value STRING, target_value STRING, status STRING",
    "gold_fraud_alerts": "alert_id STRING, rule STRING, account_id INT, evidence_keys ARRAY<STRING>, first_evidence_ts TIMESTAMP, last_source_commit_ts TIMESTAMP, alert_created_at TIMESTAMP, latency_seconds DOUBLE, published_at TIMESTAMP",
}
# What a latest-state table adds to an entity's own columns.
STATE_META = "_event_id STRING, _op STRING, _source_sequence STRING, _first_commit_ts TIMESTAMP, _last_commit_ts TIMESTAMP, _is_deleted BOOLEAN, _updated_at TIMESTAMP"
# The analyst queue.
QUEUE = "alert_id STRING, rule STRING, account_id INT, evidence_keys ARRAY<STRING>, first_evidence_ts STRING, last_source_commit_ts STRING, alert_created_at STRING, latency_seconds DOUBLE, status STRING, note STRING, decided_at STRING, received_at STRING"


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
