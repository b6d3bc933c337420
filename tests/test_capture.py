"""Validation, routing and mapping of single records."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from changeflow.functions import record as R
from changeflow.functions.documents import document_error, document_fields, lift
from changeflow.operators import capture
from changeflow.spec import ReplicationSpec

SPEC = ReplicationSpec(
    target="persons",
    pk="person_id",
    keys_prefix="person",
    mappings={"first_name": "first", "last_name": "last", "age": "age", "_hidden": "hidden"},
    types={"age": "int"},
    shards=4,
)
CHANGES = "n bigint, ms bigint, event string, key string, fields map<string,string>"
FULL = {"first_name": "foo", "last_name": "bar", "age": "22"}


def captured(spark, *records, spec=SPEC, event="hset"):
    rows = [(i, 1000 + i, event, key, fields) for i, (key, fields) in enumerate(records)]
    out = capture.capture(spark.createDataFrame(rows, CHANGES), spec)
    return sorted(out.collect(), key=lambda r: r["n"])


def test_insert_is_mapped_and_typed(spark):
    (row,) = captured(spark, ("person:1", FULL))
    assert (row["pk"], row["first"], row["last"], row["age"]) == ("1", "foo", "bar", 22)
    assert (row["op"], row["uuid"], row["route"]) == ("=", None, "replicate")


@pytest.mark.parametrize(
    "control, op, uuid, route",
    [
        (None, "=", None, "replicate"),
        ("=", "=", None, "replicate"),
        ("=1", "=", "1", "replicate"),
        ("+", "+", None, "local"),
        ("+1", "+", "1", "local"),
        ("-3", "-", "3", "local"),
        ("~", "~", None, "replicate"),
        ("~2", "~", "2", "replicate"),
        ("=6ce0c902-30c2-4ac9-8342-2f04fb359a94", "=", "6ce0c902-30c2-4ac9-8342-2f04fb359a94", "replicate"),
    ],
)
def test_control_field(spark, control, op, uuid, route):
    fields = FULL if control is None else {**FULL, "#": control}
    (row,) = captured(spark, ("person:1", fields))
    assert (row["op"], row["uuid"], row["route"], row["error"]) == (op, uuid, route, None)


def test_gone_key_is_a_delete_and_carries_no_columns(spark):
    gone, deleted = captured(spark, ("person:1", None), ("person:2", {**FULL, "#": "~"}))
    assert [(r["op"], r["route"], r["first"]) for r in (gone, deleted)] == [("~", "replicate", None)] * 2


@pytest.mark.parametrize(
    "fields, error",
    [
        ({**FULL, "#": ""}, "no operation"),
        ({**FULL, "#": "*1"}, "unknown operation *"),
        ({"first_name": "foo", "age": "1"}, "missing field last_name"),
        ({**FULL, "age": "old"}, "bad value for age"),
    ],
)
def test_refused_records_keep_their_fields(spark, fields, error):
    (row,) = captured(spark, ("person:1", fields))
    assert (row["route"], row["error"], row["raw"]) == ("reject", error, fields)


@pytest.mark.parametrize("control", ["+", "-", "~"])
def test_only_replicated_updates_need_all_fields(spark, control):
    (row,) = captured(spark, ("person:1", {"#": control}))
    assert row["error"] is None


def test_good_and_bad_records_add_up(spark):
    rows = captured(spark, ("person:1", FULL), ("person:2", {"#": ""}), ("person:3", {**FULL, "#": "+"}))
    assert [r["route"] for r in rows] == ["replicate", "reject", "local"]


def test_prefix_and_event_filters(spark):
    assert captured(spark, ("personal:1", FULL), ("person", FULL)) == []
    assert captured(spark, ("person:1", FULL), event="expire") == []
    assert len(captured(spark, ("person:1", None), event="del")) == 1


def test_extra_key_parts_are_dropped(spark):
    (row,) = captured(spark, ("person:1:2:3", FULL))
    assert row["pk"] == "1"


def test_transform_runs_before_validation(spark):
    spec = replace(
        SPEC,
        transform=lambda df: df.withColumn(
            "fields", F.map_concat("fields", F.create_map(F.lit("age"), F.lit("7")))
        ),
    )
    (row,) = captured(spark, ("person:1", {"first_name": "a", "last_name": "b"}), spec=spec)
    assert (row["age"], row["error"]) == (7, None)


def test_what_is_not_a_hash_is_refused(spark):
    rows = [(0, 1, "hset", "person:1", "list", {})]
    df = spark.createDataFrame(
        rows, "n bigint, ms bigint, event string, key string, kind string, fields map<string,string>"
    )
    assert capture.capture(df, SPEC).first()["error"] == "not a hash"


def test_copies_carry_every_plain_field(spark):
    rows = [(0, 1, "hset", "person:1", {"a": "1", "_b": "2", "#": "=u"})]
    out = capture.normalize_copies(spark.createDataFrame(rows, CHANGES), SPEC).first()
    assert (out["fields"], out["uuid"], out["error"]) == ({"a": "1"}, "u", None)


def test_log_ids(spark):
    rows = [("9-0", "10-0", -1), ("10-0", "9-0", 1), ("10-2", "10-10", -1), ("5-5", "5-5", 0)]
    df = spark.createDataFrame(rows, "a string, b string, want int")
    compared = R.compare_ids(R.parse_log_id(F.col("a")), R.parse_log_id(F.col("b")))
    assert [r[0] for r in df.select(compared).collect()] == [r[2] for r in rows]


def test_real_key_and_ack_key(spark):
    df = spark.createDataFrame([("__{person:1}",), ("__person",)], "k string")
    assert [r[0] for r in df.select(R.real_key(F.col("k"))).collect()] == ["person:1", None]
    assert df.select(R.ack_key(F.lit("person:1"), F.lit("9"))).first()[0] == "{person:1}9"


def test_shards_stay_in_range(spark):
    shards = spark.range(2000).select(SPEC.shard(F.col("id").cast("string")).alias("s"))
    counts = {r["s"]: r["count"] for r in shards.groupBy("s").count().collect()}
    assert sorted(counts) == [0, 1, 2, 3] and min(counts.values()) > 400


@pytest.mark.parametrize(
    "doc, error",
    [
        ('{"a": 1}', None),
        ("{}", None),
        (None, None),
        ('{"note": "it\'s"}', None),
        ("not json", "not a JSON object"),
        ("[1]", "not a JSON object"),
        ("5", "not a JSON object"),
        ('{"a": 1, "a": 2}', "repeated field in the JSON object"),
    ],
)
def test_documents(spark, doc, error):
    df = spark.createDataFrame([(doc,)], "doc string")
    text = F.col("doc")
    assert df.select(document_error(text, document_fields(text))).first()[0] == error


def test_lift_decodes_and_lifts(spark):
    cols = F.create_map(
        F.lit("id"), F.lit("007"), F.lit("n"), F.lit("5"), F.lit("d"), F.lit('{"n": 6, "x": {"y": ["it\'s"]}}')
    )
    got = spark.range(1).select(F.to_json(lift(cols, "d"))).first()[0]
    assert got == '{"id":"007","n":6,"x":{"y":["it\'s"]}}'


def test_spec_refuses_nonsense():
    for change in ({"keys_prefix": ""}, {"shards": 0}, {"mappings": {"a": "x", "b": "x"}}, {"mappings": {"a": "person_id"}}):
        with pytest.raises(ValueError):
            replace(SPEC, **change)
    assert "hidden" not in SPEC.columns
