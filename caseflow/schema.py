"""Column lists of the ticket data model (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "unique_key"
CREATED = "created_date"
CLOSED = "closed_date"
TARGET = "resolution_time_hours"

RAW_COLUMNS = [
    "unique_key", "created_date", "closed_date", "agency", "complaint_type", "descriptor",
    "borough", "location_type", "incident_zip", "latitude", "longitude", "community_board",
    "council_district", "police_precinct",
]

CATEGORICAL = [
    "agency", "complaint_type", "descriptor", "borough", "location_type", "incident_zip",
    "community_board", "council_district", "police_precinct", "city",
]
NUMERIC = ["latitude", "longitude"]
TIME_FEATURES = ["created_hour", "created_dayofweek", "created_month", "created_is_weekend"]
LEAKING = [CLOSED, TARGET]

SEED = 42
N_SPLITS = 5
STRAT_BINS = 10


def text_schema(columns: list[str]) -> T.StructType:
    """Raw files are read as text throughout: codes such as zips keep their leading zeros."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def present(columns: list[str], candidates: list[str]) -> list[str]:
    """Candidates that exist, in candidate order."""
    return [c for c in candidates if c in columns]
