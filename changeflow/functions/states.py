"""State before each record of a key, where records change a set of bits, by composing functions.

A record is a function on a bit set ``s``: the result of the first of its guards ``(g, r)`` with
``s & g = 0``, which is ``r``; without such a guard ``(s & a) | b``. Such functions stay of that
form when they are composed, and few guards are enough: one whose bits include those of an
earlier guard never comes first. So records are folded in groups of ``FAN``, the groups of
a key again in groups, and so on up to the key; then the state before each group is handed
down the same way. Every step looks at a bounded number of rows of one group, and the number of steps grows
with the logarithm of the rows of a key, whatever the records do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.session import stored

_BITS = 8
FAN = 1 << _BITS
_GUARDS = "array<struct<g:bigint,r:bigint>>"


def function(a: Column, b: Column, guard: Column | None = None, result: int = 0) -> Column:
    """``(s & a) | b``, or ``result`` where none of the bits of ``guard`` is set."""
    if guard is None:
        guards = F.array().cast(_GUARDS)
    else:
        guards = F.array(F.struct(guard.cast("bigint").alias("g"), F.lit(result).cast("bigint").alias("r"))).cast(_GUARDS)
    return F.struct(guards.alias("guards"), a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))


def applied(f: Column, s: Column) -> Column:
    first = F.get(F.filter(f["guards"], lambda x: s.bitwiseAND(x["g"]) == 0), F.lit(0))
    return F.coalesce(first["r"], s.bitwiseAND(f["a"]).bitwiseOR(f["b"]))


def composed(x: Column, y: Column) -> Column:
    """First ``x``, then ``y``."""
    fired = F.transform(x["guards"], lambda k: F.struct(k["g"].alias("g"), applied(y, k["r"]).alias("r")))
    # A guard of y holds after (s & a) | b only if b leaves it free.
    free = F.filter(y["guards"], lambda k: x["b"].bitwiseAND(k["g"]) == 0)
    lifted = F.transform(free, lambda k: F.struct(x["a"].bitwiseAND(k["g"]).alias("g"), k["r"].alias("r")))

    def add(known: Column, new: Column) -> Column:
        covered = F.exists(known, lambda k: k["g"].bitwiseAND(new["g"]) == k["g"])
        return F.when(covered, known).otherwise(F.concat(known, F.array(new)))

    return F.struct(
        F.aggregate(lifted, fired.cast(_GUARDS), add).alias("guards"),
        x["a"].bitwiseAND(y["a"]).alias("a"),
        x["b"].bitwiseAND(y["a"]).bitwiseOR(y["b"]).alias("b"),
    )


def states_before(records: DataFrame, start: DataFrame, key: str) -> DataFrame:
    """(key, at, s): the state before each record.

    ``records`` has the key, a number ``at`` that rises along the key, and the function ``f``;
    ``start`` has the state ``s`` of each key before its first record.
    """
    up = F.shiftright("at", _BITS)
    levels = [stored(records.select(key, F.col("at").cast("bigint").alias("at"), "f"), "state-functions")]
    while (levels[-1].agg(F.max("at")).first()[0] or 0) >= FAN:
        levels.append(stored(_grouped(levels[-1], key, up).select(key, "at", _folded().alias("f")), "state-functions"))
    states = start.select(key, F.lit(0).cast("bigint").alias("at"), F.col("s").cast("bigint").alias("s"))
    for level in reversed(levels):
        # Both sides grow with the records, whatever the size of their files says: nothing is broadcast.
        before = _grouped(level, key, up).join(states.hint("merge"), [key, "at"]).select(key, F.explode(_scanned()).alias("e"))
        states = stored(before.select(key, "e.at", "e.s"), "states")
    return states


def _grouped(level: DataFrame, key: str, up: Column) -> DataFrame:
    """At most ``FAN`` functions per row, in order."""
    grouped = level.groupBy(key, up.alias("group")).agg(F.array_sort(F.collect_list(F.struct("at", "f"))).alias("own"))
    return grouped.withColumnRenamed("group", "at")


def _folded() -> Column:
    identity = function(F.lit(-1), F.lit(0))
    return F.aggregate("own", identity, lambda known, one: composed(known, one["f"]))


def _scanned() -> Column:
    """(at, s) of each function of the row: the state before it."""
    nothing = F.array().cast("array<struct<at:bigint,s:bigint>>")
    start = F.struct(F.col("s").alias("s"), nothing.alias("seen"))

    def step(known: Column, one: Column) -> Column:
        here = F.array(F.struct(one["at"].alias("at"), known["s"].alias("s")))
        return F.struct(applied(one["f"], known["s"]).alias("s"), F.concat(known["seen"], here).alias("seen"))

    return F.aggregate("own", start, step, lambda known: known["seen"])
