"""Structured Streaming forms of ingest, dedup, daily bars, upsert and analytics refresh."""

from barlake.streaming.ingest import dedup_stream, parse_records, start_bronze_append
from barlake.streaming.bars import bars_from_stream, close_days, read_bar_log, start_bar_log
from barlake.streaming.landing import start_landing
from barlake.streaming.upsert import start_gold_refresh, start_silver_upsert

__all__ = [
    "bars_from_stream",
    "close_days",
    "dedup_stream",
    "parse_records",
    "read_bar_log",
    "start_bar_log",
    "start_bronze_append",
    "start_gold_refresh",
    "start_landing",
    "start_silver_upsert",
]
