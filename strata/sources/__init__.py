"""Sources: CSV, JSON lines, Parquet tables and JSON message topics."""

from strata.sources.files import read_csv, read_json_lines, read_reference, read_table
from strata.sources.messages import (FileTopic, KafkaTopic, decode_messages, publish,
                                     publish_csv, read_topic, replay_topic)

__all__ = [
    "read_csv", "read_json_lines", "read_reference", "read_table",
    "FileTopic", "KafkaTopic", "decode_messages", "publish", "publish_csv", "read_topic",
    "replay_topic",
]
