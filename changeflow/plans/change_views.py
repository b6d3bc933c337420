"""A change log, staged writes and target tables over the driver tables.

``events`` is the log: its ids ascend with its timestamps, and each event is one
change of the hash ``user:<15 * user_id>`` (some go to ``guest:`` and stray
keys). ``customer`` is the replication target before the log is applied.
``plans/oracles.py`` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.record import once
from changeflow.spec import DOCUMENT_EVENTS, STAGED_EVENTS, ReplicationSpec

SHARDS = 4


def _pk_mod(pk: Column) -> Column:
    # The SQL side has no xxhash64, so the checked queries shard by remainder.
    return F.pmod(pk.try_cast("bigint"), F.lit(SHARDS))


USERS = ReplicationSpec(
    target="customer",
    pk="c_custkey",
    keys_prefix="user",
    mappings={"type": "c_mktsegment", "value": "c_acctbal", "_seq": "ignored"},
    types={"c_acctbal": "double"},
    shards=SHARDS,
    shard_by=_pk_mod,
    batch=100,
)
GUESTS = ReplicationSpec(
    target="guests",
    pk="guest_id",
    keys_prefix="guest",
    mappings={"type": "last_type", "k": "last_k"},
    types={"last_k": "int"},
    shards=SHARDS,
    shard_by=_pk_mod,
)
COPIES = ReplicationSpec(
    target="copies",
    pk="key",
    keys_prefix="user",
    whole_hashes=True,
    shards=SHARDS,
    shard_by=_pk_mod,
)
DOCUMENTS = ReplicationSpec(
    target="profiles",
    pk="user_id",
    keys_prefix="user",
    event_types=DOCUMENT_EVENTS,
    shards=SHARDS,
    shard_by=_pk_mod,
)
STAGED = ReplicationSpec(
    target="customer",
    pk="c_custkey",
    keys_prefix="__",
    mappings={"type": "c_mktsegment", "value": "c_acctbal", "k": "c_k"},
    types={"c_acctbal": "double", "c_k": "int"},
    event_types=STAGED_EVENTS,
    shards=SHARDS,
    shard_by=_pk_mod,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millis(ts: Column) -> Column:
    """Milliseconds since 1970 of a time without zone, whatever the session zone."""
    seconds = (ts - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).cast("interval second")
    # Exact: a double holds the microseconds of some 280 years.
    micros = F.rint(seconds.cast("decimal(18,6)").cast("double") * 1_000_000).cast("bigint")
    return F.call_function("div", micros, F.lit(1000))


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumns(
        {
            "n": F.col("event_id"),
            "ms": _millis(F.col("ts")),
            "account": (F.col("user_id") * 15).cast("string"),
            "uuid_text": F.when(
                _every(3), F.concat(F.lit("u"), F.col("event_id").cast("string"))
            ).otherwise(F.lit("")),
        }
    )


def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log id of each event, and its user."""
    return _events(spark, sf_dir).select("n", "ms", "user_id")


def _control_text() -> Column:
    """Null where the record carries no control field."""
    operation = (
        F.when(F.col("event_type") == "error", F.when(_every(2), "~").otherwise("-"))
        .when(F.col("event_type") == "signup", "+")
        .when((F.col("event_type") == "view") & _every(5), F.lit(None))
        .otherwise("=")
    )
    return (
        F.when(_every(97), F.lit(""))
        .when(_every(89), F.concat(F.lit("*"), F.col("uuid_text")))
        .otherwise(F.concat(operation, F.col("uuid_text")))
    )


def _hash(control: Column, unfit: Column) -> Column:
    """The changed hash; a field with a null value counts as absent."""
    value = F.when(_every(101), unfit).otherwise(F.col("value").cast("string"))
    return F.create_map(
        F.lit("type"),
        F.col("event_type"),
        F.lit("value"),
        F.when(F.col("event_type") != "click", value),
        F.lit("k"),
        F.get_json_object("props", "$.k"),
        F.lit("_seq"),
        F.col("event_id").cast("string"),
        F.lit("#"),
        control,
    )


def hash_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = (F.col("event_type") == "error") & _every(4)
    key = (
        F.when(_every(79), F.lit("orphan"))
        .when(_every(13) & _every(17), F.concat(F.lit("guest:"), F.col("user_id"), F.lit(":x")))
        .when(_every(13), F.concat(F.lit("guest:"), F.col("user_id")))
        .otherwise(F.concat(F.lit("user:"), F.col("account")))
    )
    event = (
        F.when(_every(11), F.lit("expire"))
        .when(gone, F.lit("del"))
        .when(_every(2), F.lit("hmset"))
        .otherwise(F.lit("hset"))
    )
    return _events(spark, sf_dir).select(
        "n",
        "ms",
        event.alias("event"),
        key.alias("key"),
        F.when(_every(83), F.lit("string")).otherwise(F.lit("hash")).alias("kind"),
        once(F.when(~gone, _hash(_control_text(), F.lit("n/a")))).alias("fields"),
    )


def document_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.concat(
        F.lit('{"type":"'),
        F.col("event_type"),
        F.lit('","props":'),
        F.col("props"),
        F.when(
            F.col("event_type") != "click",
            F.concat(F.lit(',"cents":'), F.round(F.col("value") * 100).cast("bigint")),
        ).otherwise(F.lit("")),
        F.when(_every(7), F.lit(',"note":"it\'s"')).when(_every(5), F.lit(',"note":null')).otherwise(F.lit("")),
        F.lit("}"),
    )
    doc = (
        F.when((F.col("event_type") == "error") & _every(2), F.lit(None))
        .when(_every(59), F.lit("not json"))
        .when(_every(61), F.lit("[1,2]"))
        .when(_every(53), F.lit("{}"))
        .otherwise(whole)
    )
    event = F.when(_every(11), F.lit("json.get")).when(doc.isNull(), F.lit("json.del")).otherwise(F.lit("json.set"))
    return _events(spark, sf_dir).select(
        "n",
        "ms",
        event.alias("event"),
        F.concat(F.lit("user:"), F.col("account")).alias("key"),
        once(doc).alias("doc"),
    )


def staged_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as writes to staging keys, unfit values in replicated and local ones."""
    fields = _hash(_control_text(), F.lit("n/a"))
    key = F.when(_every(79), F.lit("__")).otherwise(
        F.concat(F.lit("__{user:"), F.col("account"), F.lit("}"))
    )
    event = F.when(_every(11), F.lit("expire")).when(_every(2), F.lit("hmset")).otherwise(F.lit("hset"))
    return _events(spark, sf_dir).select(
        "n", "ms", event.alias("event"), key.alias("key"), once(fields).alias("fields")
    )


def staged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = document_changes(spark, sf_dir)
    return changes.withColumn("key", F.concat(F.lit("__{"), F.col("key"), F.lit("}")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target table before the log."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        "c_mktsegment",
        "c_acctbal",
    )


def customers_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).withColumn("c_k", F.lit(None).cast("int"))


def source_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source before the log: one hash per customer, every second one without ``value``."""
    fields = F.create_map(
        F.lit("name"),
        F.col("c_name"),
        F.lit("type"),
        F.col("c_mktsegment"),
        F.lit("k"),
        F.col("c_nationkey").cast("string"),
        F.lit("value"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal").cast("string")),
    )
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user:"), F.col("c_custkey")).alias("key"),
        fields.alias("fields"),
    )


def profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document target before the log, keyed by customer."""
    doc = F.concat(
        F.lit('{"name":"'), F.col("c_name"), F.lit('","type":"'), F.col("c_mktsegment"), F.lit('"}')
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.from_json(doc, "map<string,variant>").alias("fields"),
    )


def watermark(spark: SparkSession, sf_dir: str, spec: ReplicationSpec = USERS) -> DataFrame:
    """Positions as if the events before the 11th of January were applied; shard 0 has none."""
    seen = _events(spark, sf_dir).where(
        F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-11 00:00:00'")
    )
    return (
        seen.select(spec.shard(F.col("account")).alias("shard"), F.struct("ms", "n").alias("id"))
        .where(F.col("shard") != 0)
        .groupBy(F.lit(spec.target).alias("target"), "shard")
        .agg(F.max("id").alias("id"))
        .select("target", "shard", F.lit(0).cast("bigint").alias("arrived"), "id.ms", "id.n")
    )
