import json

from chargepulse.sources.kafka import kafka_sink_options, kafka_source_options
from chargepulse.sources.offsets import ledger_quarantine, ledger_rows, starting_offsets_json
from chargepulse.streaming.sinks import jdbc_options


def test_kafka_options():
    o = kafka_source_options("b:9092", {"recharge"}, max_rate_per_partition=10000,
                             partitions=3, interval_sec=2)
    assert o["subscribe"] == "recharge" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "60000"
    assert kafka_source_options("b", ["b", "a"])["subscribe"] == "a,b"
    assert kafka_source_options("b", "t", min_partitions=64)["minPartitions"] == "64"
    assert kafka_source_options("b", "t", max_offsets_per_trigger=500)["maxOffsetsPerTrigger"] == "500"
    assert kafka_sink_options("b", "t") == {"kafka.bootstrap.servers": "b", "topic": "t"}


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://h/db", "province_hour_failures", user="u", password="p", truncate=True)
    assert o["dbtable"] == "province_hour_failures" and o["truncate"] == "true" and o["batchsize"] == "1000"


def test_ledger_hyphenated_topic(spark):
    ledger = spark.createDataFrame(
        [("g", "t-a-1", "9"), ("g", "t-a-0", "5"), ("g", "b-10", "3"), ("g", "b-2", "4"),
         ("h", "x-0", "1"), ("g", "nopartition", "7")],
        "group_id string, field string, offset string")
    ledger = ledger.unionByName(spark.createDataFrame(
        [("g", "t-a-1", "4"), ("g", "bad", "7"), ("g", "t-a-2", "x"), ("g", "t-a-3", None), ("g", "t-a-9999999999", "1")], ledger.schema))
    rows = sorted(tuple(r) for r in ledger_rows(ledger).collect())
    bad = sorted((r.field, r.offset) for r in ledger_quarantine(ledger).collect())
    assert bad == [("bad", "7"), ("nopartition", "7"), ("t-a-2", "x"), ("t-a-3", None), ("t-a-9999999999", "1")]
    assert ("g", "t-a", 1, 9) in rows and ("g", "b", 10, 3) in rows and len(rows) == 5
    got = {r.group_id: (r.partitions, r.starting_offsets)
           for r in starting_offsets_json(ledger).collect()}
    assert got["g"][0] == 4
    assert got["g"][1] == '{"b":{"2":4,"10":3},"t-a":{"0":5,"1":9}}'
    assert json.loads(got["h"][1]) == {"x": {"0": 1}}
