"""The registered queries: one or more per operator, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions import record as R
from changeflow.functions.documents import lift
from changeflow.operators import apply, batches, capture, delivery, fold, through
from changeflow.plans import change_views as V
from changeflow.plans.recipes import DocumentWriteBehind, WriteBehind, WriteThrough
from changeflow.session import new_dir, shared_dir, stored
from changeflow.sinks.table import TableSink
from changeflow.sources import log as log_source
from changeflow.spec import ReplicationSpec
from changeflow.streaming.apply_log import apply_batch, net_of
from changeflow.streaming.capture_log import start_capture
from changeflow.streaming.fan_out import read_log, start_fan_out

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_LOG = ["target", "shard", "ms", "n", "key", "pk", "op", "uuid", *V.USERS.columns]
_ONCE = {"availableNow": True}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def _captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.capture(V.hash_changes(spark, sf_dir), V.USERS)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.replicated(_captured(spark, sf_dir))


def _net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.net_change(_log(spark, sf_dir), V.USERS.columns)


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.select_events(V.hash_changes(spark, sf_dir), V.USERS)


def _field(name: str) -> Column:
    return F.col("fields")[name].alias("f_seq" if name == "_seq" else f"f_{name}")


def _document_rows(documents: DataFrame, pk: str) -> DataFrame:
    """Documents as one row per field, values as JSON text."""
    return documents.select(
        F.col(pk).alias("pk"), F.explode_outer("fields").alias("field", "v")
    ).select("pk", "field", F.when(F.col("v").isNotNull(), F.to_json("v")).alias("value"))


# Sources


@_query
def a1_hash_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.hash_changes(spark, sf_dir).select(
        "n", "ms", "event", "key", "kind", _field("type"), _field("value"), _field("k"),
        F.col("fields")["#"].alias("control"),
    )


@_query
def a2_json_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.document_changes(spark, sf_dir).select(
        "n", "ms", "key", "doc", R.operation(R.document_control(F.col("doc"))).alias("op")
    )


@_query
def a3_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _written_log(spark, sf_dir)
    # The positions lie in the first batch of the log, which is its only one.
    held = V.watermark(spark, sf_dir).withColumn("arrived", F.lit(1).cast("bigint"))
    return delivery.skip_applied(log, held).select(*_LOG)


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured records as a log table: all three routes."""
    path = new_dir(spark, "log")
    log_source.append(_captured(spark, sf_dir), path, V.USERS)
    return log_source.read(spark, path, V.USERS)


def _written_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.replicated(_written(spark, sf_dir))


# Validation and projection


@_query
def b1_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("key")
    through_prefix = R.staged_under(key, V.USERS.keys_prefix)
    return (
        V.hash_changes(spark, sf_dir)
        .where(through_prefix)
        .select(
            "n",
            "key",
            R.under_prefix(key, V.USERS.keys_prefix).alias("behind"),
            through_prefix.alias("through"),
        )
    )


@_query
def b2_event_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = V.hash_changes(spark, sf_dir)
    return changes.where(F.col("event").isin(*V.USERS.event_types)).select("n", "event", "key")


def _loud_type(changes: DataFrame) -> DataFrame:
    louder = F.transform_values(
        "fields", lambda k, v: F.when(k == "type", F.upper(v)).otherwise(v)
    )
    return changes.withColumn("fields", louder)


@_query
def b3_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = replace(V.USERS, transform=_loud_type)
    captured = capture.capture(V.hash_changes(spark, sf_dir), spec)
    return capture.replicated(captured).select("n", *spec.columns)


@_query
def b4_pk_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.hash_changes(spark, sf_dir).select("n", "key", R.primary_key(F.col("key")).alias("pk"))


@_query
def b5_real_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through.select_staged(V.staged_writes(spark, sf_dir), V.STAGED).select("n", "key")


@_query
def b6_validate_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.validate(V.hash_changes(spark, sf_dir)).select("n", "key", "op", "uuid", "error")


@_query
def b7_validate_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = capture.validate_documents(V.document_changes(spark, sf_dir))
    return checked.select("n", "op", "uuid", "error")


@_query
def b8_split_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = R.control(F.col("fields"))
    return V.hash_changes(spark, sf_dir).select(
        "n", text.alias("control"), R.operation(text).alias("op"), R.ack_uuid(text).alias("uuid")
    )


@_query
def b9_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _captured(spark, sf_dir).select("n", "op", "route")


@_query
def b10_map_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select("n", "pk", *V.USERS.columns)


@_query
def b11_missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashes = V.hash_changes(spark, sf_dir).where(
        R.under_prefix(F.col("key"), V.USERS.keys_prefix) & F.col("fields").isNotNull()
    )
    updates = capture.validate(hashes).where(F.col("error").isNull() & (F.col("op") == "="))
    return updates.select("n", "key", capture.missing_field(V.USERS).alias("missing"))


@_query
def b12_typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashes = V.hash_changes(spark, sf_dir).where(
        R.under_prefix(F.col("key"), V.USERS.keys_prefix) & F.col("fields").isNotNull()
    )
    return hashes.select(
        "n",
        F.col("fields")["value"].try_cast("double").alias("c_acctbal"),
        capture.bad_value(V.USERS).alias("unfit"),
    )


@_query
def b13_strip_reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = R.without_reserved(F.col("fields"))
    return V.hash_changes(spark, sf_dir).select("n", F.explode(plain).alias("name", "value"))


@_query
def b14_log_id_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event against the last one of its user; ids go through their text form."""
    events = V.event_ids(spark, sf_dir).select(
        "n", "user_id", R.parse_log_id(F.concat_ws("-", "ms", "n")).alias("id")
    )
    last = events.groupBy("user_id").agg(F.max("id").alias("last"))
    return events.join(last, "user_id").select(
        "n", R.compare_ids(F.col("id"), F.col("last")).alias("compared")
    )


@_query
def b15_append_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_log(spark, sf_dir).select(*_LOG)


@_query
def b16_assign_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).groupBy("pk", "shard").agg(F.count(F.lit(1)).alias("records"))


@_query
def b17_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = capture.dead_letters(_captured(spark, sf_dir))
    return rejects.withColumns(
        {"f_type": F.col("raw")["type"], "f_value": F.col("raw")["value"]}
    ).drop("raw")


# Batches


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _written_log(spark, sf_dir).select("target", "shard", "ms", "n", "pk")
    return batches.number_batches(log, V.USERS.batch)


@_query
def c1_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(spark, sf_dir).select("shard", "n", "batch_no")


#: So few that every shard of the test data counts as hot.
_FEW_ROWS = 200


@_query
def c1_batches_hot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers where shards are cut into segments."""
    log = _written_log(spark, sf_dir).select("target", "shard", "ms", "n", "pk")
    numbered = batches.number_batches(log, V.USERS.batch, _FEW_ROWS)
    return numbered.select("shard", "n", "batch_no")


@_query
def c2_batch_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.changed_keys(_batched(spark, sf_dir)).select(
        "shard", "batch_no", F.array_join("keys", ",").alias("keys")
    )


@_query
def c3_batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.count_batches(_batched(spark, sf_dir)).select("shard", "batch_no", "records")


@_query
def c4_op_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.op_runs(_written_log(spark, sf_dir)).drop("target")


@_query
def c4_op_runs_hot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.op_runs(_written_log(spark, sf_dir), _FEW_ROWS).drop("target")


@_query
def c5_net_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _net(spark, sf_dir).drop("arrived")


# Target state


@_query
def d1_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.delete(V.customers(spark, sf_dir), _net(spark, sf_dir), V.USERS.pk)


@_query
def d2_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.upsert_merge(V.customers(spark, sf_dir), _net(spark, sf_dir), V.USERS)


@_query
def d2_upsert_merge_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    net = _net(spark, sf_dir).checkpoint()
    return apply.upsert_merge_small(V.customers(spark, sf_dir), net, V.USERS)


@_query
def d3_upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.upsert_replace(V.customers(spark, sf_dir), _net(spark, sf_dir), V.USERS)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = capture.capture_documents(V.document_changes(spark, sf_dir), V.DOCUMENTS)
    return capture.replicated(captured)


@_query
def d4_doc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = fold.net_fields(_documents(spark, sf_dir))
    merged = apply.merge_fields(V.profile_documents(spark, sf_dir), net, V.DOCUMENTS.pk)
    return _document_rows(merged, V.DOCUMENTS.pk)


@_query
def d5_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = capture.select_events(V.document_changes(spark, sf_dir), V.DOCUMENTS)
    good = (
        capture.validate_documents(changes)
        .withColumn("pk", R.primary_key(F.col("key")))
        .where("error IS NULL AND op = '='")
    )
    columns = F.create_map(
        F.lit("user_id"), F.col("pk"), F.lit("event"), F.lit("json.set"), F.lit("payload"), F.col("doc")
    )
    return good.select("n", F.explode(lift(columns, "payload")).alias("field", "v")).select(
        "n", "field", F.to_json("v").alias("value")
    )


@_query
def d6_hash_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = _net(spark, sf_dir).withColumn("fields", fold.mapped_as_fields(V.USERS))
    mirror = V.customers(spark, sf_dir).select(
        F.concat(F.lit("mirror:"), F.col("c_custkey")).alias("key"),
        F.create_map(
            F.lit("name"), F.col("c_name"),
            F.lit("c_mktsegment"), F.col("c_mktsegment"),
            F.lit("c_acctbal"), F.col("c_acctbal").cast("string"),
        ).alias("fields"),
    )
    merged = apply.merge_fields(mirror, apply.with_prefix(net, "mirror"), "key")
    return merged.select(
        "key", _field("name"), *[F.col("fields")[c].alias(c) for c in V.USERS.columns]
    )


@_query
def d7_hash_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = capture.replicated(capture.capture(V.hash_changes(spark, sf_dir), V.COPIES))
    net = apply.with_prefix(net_of(log, V.COPIES), "copy")
    return net.select(F.col("pk").alias("key"), _field("type"), _field("k"), _field("value"))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = capture.validate(_selected(spark, sf_dir))
    return checked.where(F.col("fields").isNull() | (F.col("kind") == "hash"))


def _source_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = fold.last_image(_validated(spark, sf_dir))
    return apply.source_state(V.source_hashes(spark, sf_dir), images)


@_query
def d8_source_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _source_after(spark, sf_dir).select(
        "key", _field("name"), _field("type"), _field("value"), _field("k"), _field("_seq")
    )


@_query
def d9_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source_after(spark, sf_dir).select(
        R.primary_key(F.col("key")).alias("pk"),
        *[F.col("fields")[s].try_cast(V.USERS.type_of(c)).alias(c) for s, c in V.USERS.fields.items()],
    )
    return apply.drift(source, d2_upsert_merge(spark, sf_dir), V.USERS)


# Delivery


@_query
def e1_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = delivery.skip_applied(_log(spark, sf_dir), V.watermark(spark, sf_dir))
    net = fold.net_change(fresh, V.USERS.columns)
    return apply.upsert_merge(V.customers(spark, sf_dir), net, V.USERS)


@_query
def e2_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.advance(V.watermark(spark, sf_dir), _log(spark, sf_dir)).drop("arrived")


def _table(spark: SparkSession, purpose: str, spec: ReplicationSpec, mode: str = "merge", **options: str) -> TableSink:
    """A table that no other run has, with its files in the shared folder."""
    path = new_dir(spark, purpose)
    return TableSink(path.rsplit("/", 1)[-1].replace("-", "_"), spec, mode, location=path, **options)


def _customer_sink(spark: SparkSession, sf_dir: str, mode: str = "merge") -> TableSink:
    sink = _table(spark, "customer", V.USERS, mode)
    sink.create(V.customers(spark, sf_dir))
    return sink


@_query
def e3_atomic_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of a table: each is seen with its positions, or not at all."""
    sink = _customer_sink(spark, sf_dir)
    log = _log(spark, sf_dir)
    middle = F.unix_millis(F.to_timestamp(F.lit("2024-01-11T00:00:00Z")))
    apply_batch(log.where(F.col("ms") < middle), V.USERS, sink)
    apply_batch(log.where(F.col("ms") >= middle), V.USERS, sink)
    return sink.read(spark)


@_query
def e3_default_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches with shards by the default hash: the rows do not depend on the shard."""
    spec = replace(V.USERS, shard_by=None, shards=16)
    sink = _table(spark, "customer", spec)
    sink.create(V.customers(spark, sf_dir))
    log = capture.replicated(capture.capture(V.hash_changes(spark, sf_dir), spec))
    middle = F.unix_millis(F.to_timestamp(F.lit("2024-01-11T00:00:00Z")))
    apply_batch(log.where(F.col("ms") < middle), spec, sink)
    apply_batch(log, spec, sink)
    return sink.read(spark)


@_query
def e4_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that overlap and come twice leave what one pass leaves."""
    sink = _customer_sink(spark, sf_dir)
    log = _log(spark, sf_dir)
    day = [
        F.unix_millis(F.to_timestamp(F.lit(f"2024-01-{d}T00:00:00Z"))) for d in ("11", "16", "21")
    ]
    apply_batch(log.where(F.col("ms") < day[1]), V.USERS, sink)
    apply_batch(log.where(F.col("ms") < day[0]), V.USERS, sink)
    apply_batch(log.where(F.col("ms") < day[2]), V.USERS, sink)
    apply_batch(log.where(F.col("ms") >= day[0]), V.USERS, sink)
    return sink.read(spark)


def _at() -> Column:
    return F.timestamp_millis(F.col("ms"))


def _plain_times(acks: DataFrame) -> DataFrame:
    """Times in UTC without zone, so that they read the same in any session."""
    to_utc = {
        c: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
        for c in ("ack_ts", "expires_at")
    }
    return acks.withColumns(to_utc)


def _all_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = _written(spark, sf_dir)
    done = delivery.acks_done(capture.replicated(captured), _at())
    local = delivery.acks_local(capture.local_only(captured), _at())
    failed = delivery.acks_failed(capture.dead_letters(captured), _at())
    return done.unionByName(local).unionByName(failed)


@_query
def e5_acks_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(delivery.acks_done(_log(spark, sf_dir), _at()))


@_query
def e6_acks_norepl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(delivery.acks_local(capture.local_only(_captured(spark, sf_dir)), _at()))


@_query
def e7_ack_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = (
        V.hash_changes(spark, sf_dir)
        .where((F.col("n") % 2 == 1) & R.under_prefix(F.col("key"), V.USERS.keys_prefix))
        .select("n", "key", F.concat(F.lit("u"), F.col("n").cast("string")).alias("uuid"))
    )
    now = F.to_timestamp(F.lit("2024-01-20T00:00:00Z"))
    return delivery.ack_status(requests, _all_acks(spark, sf_dir), now)


@_query
def e8_acks_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = capture.dead_letters(_captured(spark, sf_dir))
    return _plain_times(delivery.acks_failed(rejects, _at()))


# Write-through


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through.select_staged(V.staged_writes(spark, sf_dir), V.STAGED)


def _stored_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    writes = stored(V.staged_writes(spark, sf_dir), "staged")
    return through.select_staged(writes, V.STAGED)


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through.decide(_stored_staged(spark, sf_dir), V.source_hashes(spark, sf_dir), V.STAGED)


def _through_source(spark: SparkSession, sf_dir: str, decided: DataFrame) -> DataFrame:
    net = fold.net_fields(through.source_changes(decided), "key").withColumnRenamed("key", "pk")
    merged = apply.merge_fields(V.source_hashes(spark, sf_dir), net, "key")
    return merged.select(
        "key", _field("name"), _field("type"), _field("value"), _field("k"), _field("_seq")
    )


@_query
def f1_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = through.overlay(_staged(spark, sf_dir), V.source_hashes(spark, sf_dir))
    return over.select(
        "n", "key", _field("name"), _field("type"), _field("value"), _field("k"), _field("_seq")
    )


@_query
def f2_through_norepl(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = through.local_log(_decided(spark, sf_dir))
    return _through_source(spark, sf_dir, local)


@_query
def f3_gated_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir).select(
        "n", "key", "op", "uuid", "done", "error", *V.STAGED.columns
    )


@_query
def f3_gated_commit_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same outcome where keys are cut into segments."""
    staged, source = _stored_staged(spark, sf_dir), V.source_hashes(spark, sf_dir)
    decided = through.decide(staged, source, V.STAGED, rows_per_task=_FEW_ROWS)
    return decided.select("n", "key", "op", "uuid", "done", "error", *V.STAGED.columns)


@_query
def f3_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_source(spark, sf_dir, _decided(spark, sf_dir))


@_query
def f4_json_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = replace(V.DOCUMENTS, keys_prefix="__")
    staged = through.select_staged(V.staged_documents(spark, sf_dir), spec)
    decided = through.decide_documents(staged, spec)
    net = fold.net_fields(through.replicated_log(decided))
    merged = apply.merge_fields(V.profile_documents(spark, sf_dir), net, spec.pk)
    return _document_rows(merged, spec.pk)


# Whole replications


def _as_stream(spark: SparkSession, changes: DataFrame, path: str | None = None) -> DataFrame:
    """Change records written out in order of their ids, and read back as a stream."""
    path = path or new_dir(spark, "changes")
    ordered = changes.repartitionByRange("ms", "n").sortWithinPartitions("ms", "n")
    ordered.write.mode("append").parquet(path)
    return spark.readStream.schema(changes.schema).parquet(path)


def _ran_behind(spark: SparkSession, sf_dir: str) -> WriteBehind:
    recipe = WriteBehind(V.USERS, _customer_sink(spark, sf_dir), "users", new_dir(spark, "behind"))
    recipe.run_once(_as_stream(spark, V.hash_changes(spark, sf_dir)))
    return recipe


@_query
def g1_write_behind_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ran_behind(spark, sf_dir).sink.read(spark)


def _lasting(acks: DataFrame) -> DataFrame:
    """Acknowledgements without their times, which no two runs share."""
    return acks.select("ack_key", "key", "uuid", "status", "error")


@_query
def g1_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a write-behind acknowledges: what the target has, and what it is not meant for."""
    return _lasting(spark.read.parquet(_ran_behind(spark, sf_dir).acks_path))


@_query
def e1_late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even ids first, odd ids in a later batch: lower ids that arrive late are not skipped."""
    sink = _customer_sink(spark, sf_dir)
    recipe = WriteBehind(V.USERS, sink, "users", new_dir(spark, "behind"))
    changes, path = V.hash_changes(spark, sf_dir), new_dir(spark, "changes")
    for half in (0, 1):
        recipe.run_once(_as_stream(spark, changes.where(F.col("n") % 2 == half), path))
    return sink.read(spark)


@_query
def e1_clock_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two captures into one log, the second with a checkpoint of its own and lower ids.

    As after the loss of a checkpoint, or on a host whose clock is behind: nothing is skipped.
    """
    sink = _customer_sink(spark, sf_dir)
    recipe = WriteBehind(V.USERS, sink, "users", new_dir(spark, "behind"))
    changes = V.hash_changes(spark, sf_dir)
    for half in (0, 1):
        stream = _as_stream(spark, changes.where(F.col("n") % 2 == half))
        start_capture(stream, V.USERS, recipe.log_path, f"{recipe.root}/capture-{half}", trigger=_ONCE).awaitTermination()
        recipe.apply(spark, _ONCE).awaitTermination()
    return sink.read(spark)


def _profile_sink(spark: SparkSession, sf_dir: str) -> TableSink:
    sink = _table(spark, "profiles", V.DOCUMENTS, "fields")
    sink.create(V.profile_documents(spark, sf_dir))
    return sink


@_query
def g2_json_behind_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _profile_sink(spark, sf_dir)
    recipe = DocumentWriteBehind(V.DOCUMENTS, sink, "profiles", new_dir(spark, "behind"))
    recipe.run_once(_as_stream(spark, V.document_changes(spark, sf_dir)))
    return _document_rows(sink.read(spark), V.DOCUMENTS.pk)


def _ran_through(spark: SparkSession, sf_dir: str, times: int = 1) -> WriteThrough:
    """The staged writes as one batch of a stream, committed as often as asked for."""
    sink = _table(spark, "customer", V.STAGED)
    sink.create(V.customers_with_k(spark, sf_dir))
    keyed = replace(V.STAGED, target="source", pk="key")
    source = _table(spark, "source", keyed, "fields")
    source.create(V.source_hashes(spark, sf_dir))
    recipe = WriteThrough(replace(V.STAGED, max_retries=0), sink, source, new_dir(spark, "through"))
    staged = stored(V.staged_writes(spark, sf_dir), "staged")
    for _ in range(times):
        recipe.commit(staged, 0)
    return recipe


@_query
def g3_write_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ran_through(spark, sf_dir).sink.read(spark)


@_query
def g3_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ran_through(spark, sf_dir).source.read(spark).select(
        "key", _field("name"), _field("type"), _field("value"), _field("k"), _field("_seq")
    )


@_query
def g3_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lasting(spark.read.parquet(_ran_through(spark, sf_dir).acks_path))


@_query
def g3_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that comes twice, as after a crash, leaves source and target as one does."""
    recipe = _ran_through(spark, sf_dir, times=2)
    source = recipe.source.read(spark).select("key", _field("type"), _field("value"), _field("_seq"))
    key = F.concat(F.lit("user:"), F.col("c_custkey"))
    target = recipe.sink.read(spark).select(key.alias("key"), "c_name", "c_mktsegment", "c_acctbal", "c_k")
    return source.join(target, "key", "full_outer")


def _ran_fan_out(spark: SparkSession, sf_dir: str) -> tuple[str, TableSink, TableSink]:
    users = _customer_sink(spark, sf_dir)
    guests = _table(spark, "guests", V.GUESTS)
    guests.create(spark.createDataFrame([], V.GUESTS.target_schema))
    changes = _as_stream(spark, V.hash_changes(spark, sf_dir))
    folder = new_dir(spark, "fan-out")
    start_fan_out(changes, [(V.USERS, users), (V.GUESTS, guests)], folder, _ONCE).awaitTermination()
    return folder, users, guests


@_query
def g4_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, users, guests = _ran_fan_out(spark, sf_dir)

    def rows(sink: TableSink) -> DataFrame:
        return sink.read(spark).withColumn("target", F.lit(sink.spec.target)).withColumnRenamed(sink.spec.pk, "pk")

    return rows(users).unionByName(rows(guests), allowMissingColumns=True)


@_query
def g4_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead letters of both targets of a fan-out."""
    folder, users, guests = _ran_fan_out(spark, sf_dir)
    found = [capture.dead_letters(read_log(spark, folder, sink.spec)) for sink in (users, guests)]
    return found[0].unionByName(found[1]).select("target", "n", "key", "uuid", "error")


# Sinks


@_query
def h13_versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log appended to a table, and caught up with in one batch job."""
    sink = _customer_sink(spark, sf_dir)
    recipe = WriteBehind(V.USERS, sink, "users", new_dir(spark, "behind"))
    log_source.append(_captured(spark, sf_dir), recipe.log_path, V.USERS)
    recipe.catch_up(spark)
    return sink.read(spark)


@_query
def h12_hash_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole hashes copied under a new prefix, in two batches."""
    sink = _table(spark, "copies", V.COPIES, "fields", new_prefix="copy")
    sink.create(spark.createDataFrame([], "key string, fields map<string,string>"))
    log = capture.replicated(capture.capture(V.hash_changes(spark, sf_dir), V.COPIES))
    middle = F.unix_millis(F.to_timestamp(F.lit("2024-01-16T00:00:00Z")))
    apply_batch(log.where(F.col("ms") < middle), V.COPIES, sink)
    apply_batch(log.where(F.col("ms") >= middle), V.COPIES, sink)
    return sink.read(spark).select("key", _field("type"), _field("k"), _field("value"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
