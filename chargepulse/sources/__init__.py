"""Sources: fixture message logs, province dimension, Kafka and file streams, offsets."""

from chargepulse.sources.fixtures import (
    load_table, recharge_log, topup_log, province_lines, TABLES,
)
from chargepulse.sources.dimension import province_dim, read_province_text
from chargepulse.sources.kafka import (
    kafka_source_options, kafka_sink_options, read_kafka, write_kafka,
)
from chargepulse.sources.files import count_files, read_lines_stream, stage_in_batches, stage_lines
from chargepulse.sources.offsets import ledger_quarantine, ledger_rows, starting_offsets_json

__all__ = [
    "load_table", "recharge_log", "topup_log", "province_lines", "TABLES",
    "province_dim", "read_province_text",
    "kafka_source_options", "kafka_sink_options", "read_kafka", "write_kafka",
    "stage_lines", "stage_in_batches", "count_files", "read_lines_stream", "ledger_rows", "ledger_quarantine",
    "starting_offsets_json",
]
