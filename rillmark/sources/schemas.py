"""Declared schemas of the source tables; nothing is inferred from text files."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the source tables.
DDL = {
    "listens": "listen_hash STRING NOT NULL, listened_at TIMESTAMP NOT NULL, submitted_at TIMESTAMP, recording_msid STRING NOT NULL, artist_name STRING NOT NULL, recording_name STRING NOT NULL, release_name STRING, source_file STRING NOT NULL, dump_id STRING NOT NULL, ingestion_run_id STRING NOT NULL, ingested_at TIMESTAMP NOT NULL",
    "labels": "listen_hash STRING NOT NULL, mapper_recording_mbid STRING, label_available BOOLEAN NOT NULL",
    "canonical": "snapshot_date DATE NOT NULL, recording_mbid STRING NOT NULL, recording_name STRING NOT NULL, artist_credit_name STRING NOT NULL, artist_credit_id BIGINT, artist_mbids STRING, release_mbid STRING, release_name STRING, combined_lookup STRING, score BIGINT, source_object STRING NOT NULL, ingestion_run_id STRING NOT NULL, ingested_at TIMESTAMP NOT NULL",
    "canonical_csv": "id BIGINT, artist_credit_id BIGINT, artist_mbids STRING, artist_credit_name STRING, release_mbid STRING, release_name STRING, recording_mbid STRING, recording_name STRING, combined_lookup STRING, score BIGINT",
    "rights_holders": "holder_id STRING NOT NULL, display_name STRING NOT NULL, holder_type STRING NOT NULL, payee_status STRING NOT NULL, model_scope STRING NOT NULL, is_modeled BOOLEAN NOT NULL, rights_version STRING NOT NULL, generation_run_id STRING NOT NULL, generated_at TIMESTAMP NOT NULL",
    "ownership_splits": "recording_mbid STRING NOT NULL, rights_holder_id STRING NOT NULL, share_pct DECIMAL(9,4) NOT NULL, valid_from DATE NOT NULL, valid_to DATE NOT NULL, split_version_id STRING NOT NULL, is_modeled BOOLEAN NOT NULL, rights_version STRING NOT NULL, generation_run_id STRING NOT NULL, generated_at TIMESTAMP NOT NULL",
}

_KINDS = {"STRING": T.StringType(), "TIMESTAMP": T.TimestampType(), "DATE": T.DateType(), "BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "DECIMAL(9,4)": T.DecimalType(9, 4)}


def _struct(ddl: str) -> T.StructType:
    """The schema of a column list; made without a session, so that the module can be imported first."""
    fields = []
    for column in ddl.split(", "):
        name, kind, *rest = column.split(" ")
        fields.append(T.StructField(name, _KINDS[kind], rest != ["NOT", "NULL"]))
    return T.StructType(fields)


SCHEMAS = {name: _struct(ddl) for name, ddl in DDL.items()}


def same_shape(a: T.StructType, b: T.StructType) -> bool:
    """Equal names, order and types; nullability aside."""
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]
