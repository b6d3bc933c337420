"""Write-through: staged writes go to the target first, then to the source.

A staged write overlays the record as it stands at that moment, that is, after
all earlier staged writes of its key that succeeded. Which ones succeed is
worked out for the whole batch at once:

* a field of a key is in *deficit* since the last point that left it absent or
  unfit for its column: a delete, the state before the batch, or a local update
  (``+``, never checked) with an unfit value;
* a replicated update succeeds if its own values fit and every deficit it does
  not fill itself is older than some success, because a success leaves all
  mapped fields fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import record as R
from changeflow.functions.documents import overlaid
from changeflow.functions.running import ROWS_PER_TASK, cut_hot_keys, running, with_order
from changeflow.functions.states import function, states_before
from changeflow.operators import capture
from changeflow.session import stored
from changeflow.spec import (
    DELETE_LOCAL,
    DELETE_REPLICATE,
    UPDATE_LOCAL,
    UPDATE_REPLICATE,
    ReplicationSpec,
)

NO_REAL_KEY = "no real key in the staging key"
TARGET_DOWN = "target not available"
_SLOT, _PLACE = "_slot", "_place"


def select_staged(staged: DataFrame, spec: ReplicationSpec) -> DataFrame:
    """Writes to staging keys, addressed to their real keys."""
    chosen = staged.where(R.staged_under(F.col("key"), spec.keys_prefix))
    if "event" in staged.columns:
        chosen = chosen.where(F.col("event").isin(*spec.event_types))
    return chosen.withColumn("key", R.real_key(F.col("key")))


def overlay(staged: DataFrame, source: DataFrame) -> DataFrame:
    """Each staged write over the record that the source holds now; staged fields win."""
    current = source.select("key", F.col("fields").alias("_current"))
    over = F.map_filter("fields", lambda _, value: value.isNotNull())
    return (
        staged.join(current, "key", "left")
        .withColumn("fields", overlaid(F.col("_current"), over))
        .drop("_current")
    )


def validate_staged(staged: DataFrame) -> DataFrame:
    checked = capture.validate(staged).withColumn("pk", R.primary_key(F.col("key")))
    return checked.withColumn(
        "error",
        F.coalesce(
            F.when(F.col("key").isNull(), F.lit(NO_REAL_KEY)),
            F.col("error"),
            capture.no_key_part(),
        ),
    )


def _fits(text: Column, kind: str) -> Column:
    """Present and, as text, fit for the column type."""
    return text.isNotNull() if kind == "string" else text.try_cast(kind).isNotNull()


def decide(
    staged: DataFrame,
    source: DataFrame,
    spec: ReplicationSpec,
    target_up: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Outcome of every staged write: ``done``, its ``error``, and its after-image.

    ``target_up=False`` gives the outcome where the target takes nothing.
    ``staged`` are writes addressed to real keys, see :func:`select_staged`.
    """
    fields = spec.fields
    valid = F.col("error").isNull()
    is_plus = F.col("op") == UPDATE_LOCAL
    removes = F.col("op") == DELETE_LOCAL
    if target_up:
        removes = removes | (F.col("op") == DELETE_REPLICATE)
    has = {c: F.col(f"_own_{c}").isNotNull() for c in spec.columns}
    own = {c: F.col(f"_own_{c}") for c in spec.columns}
    fit = {c: F.col(f"_fit_{c}") for c in spec.columns}

    base = source.select("key", *[F.col("fields")[s].alias(f"_base_{c}") for s, c in fields.items()])
    # Writes without a real key have nothing in common: each is a key of its own.
    own_slot = F.coalesce("key", F.concat_ws("-", "ms", "n"))
    writes = validate_staged(staged).withColumn(_SLOT, own_slot)
    # Taken out of the map once; what follows only handles plain columns.
    writes = writes.withColumns({f"_own_{c}": F.col("fields")[s] for s, c in fields.items()})
    writes = writes.withColumns(
        {f"_fit_{c}": _fits(own[c], spec.type_of(c)) for c in spec.columns}
    )
    writes, hot = cut_hot_keys(writes, [_SLOT], rows_per_task)
    rows = writes.join(base, "key", "left")

    # The last delete and the last local write of each field before the record. A local
    # write is noted as twice its place, plus one if its value fits.
    rows = running(
        with_order(rows, [_SLOT], _PLACE),
        [_SLOT],
        hot,
        maxima={
            "_barrier": F.when(valid & removes, F.col(_PLACE)),
            **{
                f"_plus_{c}": F.when(
                    valid & is_plus & has[c], F.col(_PLACE) * 2 + fit[c].cast("bigint")
                )
                for c in spec.columns
            },
        },
    )
    if hot:
        # Each running aggregate reads its input twice then, so keep the inputs short.
        rows = stored(rows, "through")

    def in_force(place: Column) -> Column:
        return place.isNotNull() & (F.col("_barrier").isNull() | (place > F.col("_barrier")))

    def deficit(c: str) -> Column:
        """Place since which the field is open, 0 for the state before the batch."""
        plus = F.shiftright(f"_plus_{c}", 1)
        fits = F.col(f"_plus_{c}") % 2 == 1
        return (
            F.when(in_force(plus), F.when(~fits, plus))
            .when(F.col("_barrier").isNotNull(), F.col("_barrier"))
            .when(~_fits(F.col(f"_base_{c}"), spec.type_of(c)), F.lit(0).cast("bigint"))
        )

    own_unfit = F.lit(False)
    unfilled = [F.lit(None).cast("bigint")] * 2
    for c in spec.columns:
        own_unfit = own_unfit | (has[c] & ~fit[c])
        unfilled.append(F.when(~has[c], deficit(c)))
    candidate = valid & (F.col("op") == UPDATE_REPLICATE) & ~own_unfit & F.lit(target_up)
    rows = rows.withColumns({"_deficit": F.greatest(*unfilled), "_may": candidate})
    unfit_local = F.lit(False)
    for c in spec.columns:
        if spec.type_of(c) != "string":
            unfit_local = unfit_local | (is_plus & has[c] & ~fit[c])
    settled_at_once = writes.where(valid & unfit_local).isEmpty()
    rows = _successes(rows, hot, settled_at_once, removes, spec)

    # The value of each mapped field before the record: its last write since the last delete.
    stays = F.col("_ok") | (valid & is_plus)
    rows = running(
        rows,
        [_SLOT],
        hot,
        maxima={f"_last_at_{c}": F.when(stays & has[c], F.col(_PLACE)) for c in spec.columns},
        lasts={f"_last_{c}": F.when(stays & has[c], own[c]) for c in spec.columns},
    )

    def image(c: str) -> Column:
        return (
            F.when(has[c], own[c])
            .when(in_force(F.col(f"_last_at_{c}")), F.col(f"_last_{c}"))
            .when(F.col("_barrier").isNull(), F.col(f"_base_{c}"))
        )

    rows = rows.withColumns({f"_image_{c}": image(c) for c in spec.columns})
    update = F.col("op") == UPDATE_REPLICATE
    missing = F.coalesce(
        F.lit(None).cast("string"),
        *[F.when(F.col(f"_image_{c}").isNull(), F.lit(s)) for s, c in fields.items()],
    )
    unfit = F.coalesce(
        F.lit(None).cast("string"),
        *[
            F.when(~_fits(F.col(f"_image_{c}"), spec.type_of(c)), F.lit(c))
            for c in spec.columns
        ],
    )
    error = F.coalesce(
        F.col("error"),
        F.when(update & ~F.col("_ok"), F.concat(F.lit("missing field "), missing)),
        F.when(update & ~F.col("_ok"), F.concat(F.lit("bad value for "), unfit)),
    )
    if not target_up:
        error = F.coalesce(
            error, F.when(capture.is_replicated(F.col("op")), F.lit(TARGET_DOWN))
        )
    return rows.select(
        F.lit(spec.target).alias("target"),
        spec.shard(F.col("pk")).alias("shard"),
        "ms",
        "n",
        "key",
        "pk",
        "op",
        "uuid",
        error.isNull().alias("done"),
        error.alias("error"),
        "fields",
        *[
            F.when(F.col("_ok"), F.col(f"_image_{c}").try_cast(spec.type_of(c))).alias(c)
            for c in spec.columns
        ],
    )


def _successes(rows: DataFrame, hot: bool, settled_at_once: bool, removes: Column, spec: ReplicationSpec) -> DataFrame:
    """Mark the replicated updates that succeed as ``_ok``.

    Without unfit local updates all deficits of a key start at one point, and the
    first success after it has none open, so one step settles everything. Else the open fields of a
    key are bits, and each write is a function on them: a delete opens all fields, a local update
    closes its fit fields and opens its unfit ones, and a replicated update closes all if it fills
    those that are open, and else does nothing.
    """
    if settled_at_once:
        known = rows.withColumn("_ok", F.col("_may") & F.col("_deficit").isNull())
        after = running(known, [_SLOT], hot, maxima={"_won": F.when(F.col("_ok"), F.col(_PLACE))})
        reached = F.col("_deficit").isNull() | F.coalesce(F.col("_won") > F.col("_deficit"), F.lit(False))
        settled = after.withColumn("_ok", F.col("_may") & reached).drop("_won")
        return stored(settled, "through") if hot else settled

    def bits(conditions: dict[str, Column]) -> Column:
        return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())), F.lit(0)).cast("bigint")

    everything = F.lit((1 << len(spec.columns)) - 1).cast("bigint")
    has = {c: F.col(f"_own_{c}").isNotNull() for c in spec.columns}
    rows = stored(rows, "through")
    valid = F.col("error").isNull()
    plus = valid & (F.col("op") == UPDATE_LOCAL)
    own, unfit = bits(has), bits({c: h & ~F.col(f"_fit_{c}") for c, h in has.items()})
    others = everything.bitwiseAND(F.bitwise_not(own))
    change = (
        F.when(valid & removes, function(F.lit(0), everything))
        .when(plus, function(others, unfit))
        .when(F.col("_may"), function(everything, F.lit(0), guard=others))
    )
    writes = rows.select(_SLOT, F.col(_PLACE).alias("at"), change.alias("f")).where("f IS NOT NULL")
    base = bits({c: ~_fits(F.col(f"_base_{c}"), spec.type_of(c)) for c in spec.columns})
    states = states_before(writes, rows.groupBy(_SLOT).agg(F.max(base).alias("s")), _SLOT)
    # There is a state for every write, in files so small that Spark would broadcast them.
    found = rows.join(states.withColumnRenamed("at", _PLACE).hint("merge"), [_SLOT, _PLACE], "left")
    closed = F.coalesce(F.col("s").bitwiseAND(others) == 0, F.lit(False))
    return stored(found.withColumn("_ok", F.col("_may") & closed).drop("s"), "through")


def replicated_log(decided: DataFrame) -> DataFrame:
    """Staged writes that reach the target, as log records."""
    return decided.where(F.col("done") & capture.is_replicated(F.col("op"))).drop("done", "error")


def local_log(decided: DataFrame) -> DataFrame:
    """Staged writes that only touch the source."""
    return decided.where(F.col("done") & ~capture.is_replicated(F.col("op")))


def source_changes(decided: DataFrame) -> DataFrame:
    """What the staged writes do to the source, as field-wise changes.

    Fields without the control field; both kinds of delete remove the record.
    """
    removes = F.col("op").isin(DELETE_REPLICATE, DELETE_LOCAL)
    return R.positioned(decided).where("done").select(
        "key",
        "arrived",
        "ms",
        "n",
        F.when(removes, DELETE_REPLICATE).otherwise(UPDATE_REPLICATE).alias("op"),
        R.without_control(F.col("fields")).alias("fields"),
    )


def decide_documents(
    staged: DataFrame, spec: ReplicationSpec, target_up: bool = True
) -> DataFrame:
    """Outcome of staged documents; any JSON object succeeds."""
    checked = capture.validate_documents(staged).withColumn("pk", R.primary_key(F.col("key")))
    error = F.coalesce(
        F.when(F.col("key").isNull(), F.lit(NO_REAL_KEY)),
        capture.no_key_part(),
        F.col("error"),
        F.lit(None if target_up else TARGET_DOWN),
    )
    return checked.select(
        F.lit(spec.target).alias("target"),
        spec.shard(F.col("pk")).alias("shard"),
        "ms",
        "n",
        "key",
        "pk",
        "op",
        "uuid",
        error.isNull().alias("done"),
        error.alias("error"),
        "fields",
    )
