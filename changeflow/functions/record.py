"""Column expressions over a single change record. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.spec import (
    DELETE_REPLICATE,
    OP_FIELD,
    OPERATIONS,
    RESERVED_PREFIX,
    UPDATE_REPLICATE,
)


def under_prefix(key: Column, prefix: str) -> Column:
    """Keys of a write-behind source: ``prefix:...``."""
    return key.startswith(prefix + ":")


def staged_under(key: Column, prefix: str) -> Column:
    """Keys of a write-through source: ``prefix...``, no separator asked for."""
    return key.startswith(prefix)


def primary_key(key: Column) -> Column:
    """Second ``:`` part of the key, null if there is none."""
    return F.try_element_at(F.split(key, ":"), F.lit(2))


def real_key(staged_key: Column) -> Column:
    """``prefix{real}`` to ``real``, null if there are no braces."""
    return F.nullif(F.regexp_extract(staged_key, r"\{([^}]*)\}", 1), F.lit(""))


def control(fields: Column) -> Column:
    """Control text of a hash record: no hash means delete, no field means update."""
    return F.when(fields.isNull(), F.lit(DELETE_REPLICATE)).otherwise(
        F.coalesce(fields[OP_FIELD], F.lit(UPDATE_REPLICATE))
    )


def document_control(doc: Column) -> Column:
    """Control text of a document record; documents carry no operation of their own."""
    return F.when(doc.isNull(), F.lit(DELETE_REPLICATE)).otherwise(F.lit(UPDATE_REPLICATE))


def operation(text: Column) -> Column:
    return F.substring(text, 1, 1)


def ack_uuid(text: Column) -> Column:
    """What follows the operation character, null if nothing does."""
    return F.nullif(F.substring(text, 2, 2_147_483_647), F.lit(""))


def operation_error(text: Column) -> Column:
    """Why the control text is refused, null if it is not."""
    return F.when(text == "", F.lit("no operation")).when(
        ~operation(text).isin(*OPERATIONS),
        F.concat(F.lit("unknown operation "), operation(text)),
    )


def without_reserved(fields: Column) -> Column:
    """Drop the control field, every field that starts with ``_``, and nulls.

    Hashes have no null values; where a table holds some they mean that there is
    no such field.
    """
    return F.map_filter(
        fields,
        lambda name, value: ~name.startswith(RESERVED_PREFIX)
        & (name != OP_FIELD)
        & value.isNotNull(),
    )


def without_control(fields: Column) -> Column:
    """Drop the control field and nulls: what the source keeps of a hash."""
    return F.map_filter(fields, lambda name, value: (name != OP_FIELD) & value.isNotNull())


def log_id(ms: Column | None = None, n: Column | None = None) -> Column:
    """Log position as a struct; structs compare part by part, numerically."""
    return F.struct(
        (F.col("ms") if ms is None else ms).alias("ms"),
        (F.col("n") if n is None else n).alias("n"),
    )


def positioned(log: DataFrame) -> DataFrame:
    """The log with the number that each record's batch has in it; 0 where it was not appended to a log."""
    return log if "arrived" in log.columns else log.withColumn("arrived", F.lit(0).cast("bigint"))


def position() -> Column:
    """Place in the log: number of the capture batch, log id within one.

    Ids come with the records, so a file that arrives late may hold low ones. The number, which
    the log gives out, makes it the later part of the log all the same.
    """
    return F.struct("arrived", "ms", "n")


def parse_log_id(text: Column) -> Column:
    """``<ms>-<counter>`` to the struct."""
    parts = F.split(text, "-")
    return log_id(parts[0].cast("bigint"), parts[1].cast("bigint"))


def compare_ids(left: Column, right: Column) -> Column:
    """-1, 0 or 1 as ``left`` lies before, at or after ``right``."""
    return F.when(left < right, -1).when(left > right, 1).otherwise(0)


def ack_key(key: Column, uuid: Column) -> Column:
    """Name under which an acknowledgement is published: ``{key}uuid``."""
    return F.concat(F.lit("{"), key, F.lit("}"), uuid)


def once(column: Column) -> Column:
    """The column, computed once per row.

    Catalyst moves a filter below the projection it reads and repeats its
    expressions there. It does not move one below a generator, so an expression
    that is dear (a parse, a map that is put together) is better generated.
    """
    return F.explode(F.array(column))


def digest_of(df: DataFrame, columns: list[str]) -> tuple[int, str]:
    """Number of the records and a digest of what they hold in ``columns``, whatever their order.

    Sums of two hashes per record; maps count by their sorted entries.
    """

    def plain(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, T.MapType):
            return F.to_json(name) if isinstance(kind.valueType, T.VariantType) else F.array_sort(F.map_entries(name))
        return F.col(name)

    values = [plain(c) for c in columns]
    # As decimals, because a sum of longs may leave their range.
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    count, *parts = df.agg(F.count(F.lit(1)), *sums).first()
    return count, "/".join(p or "" for p in parts)
