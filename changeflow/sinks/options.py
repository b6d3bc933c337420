"""Sink options that may be given as values or as functions without arguments."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import TypeVar

from pyspark.sql import DataFrame

from changeflow.spec import ReplicationSpec

Value = TypeVar("Value")
Lazy = Value | Callable[[], Value]


def resolve(option: Lazy[Value]) -> Value:
    """The value now; functions are asked again each time, so secrets may change."""
    return option() if callable(option) else option


def shard_name(spec: ReplicationSpec, shard: int) -> str:
    """Name of a position: one table holds those of several replications."""
    return f"{_named(spec)}shard-{shard}"


def own_positions(spec: ReplicationSpec, rows: Iterable[tuple[str, str]]) -> list[tuple]:
    """Rows of the watermark from the names and texts in a positions table."""
    own = _named(spec)
    found = [(name.removeprefix(own), text) for name, text in rows if name.startswith(own)]
    return [(spec.target, int(s.removeprefix("shard-")), *position_of(text)) for s, text in found]


def moved_positions(spec: ReplicationSpec, positions: DataFrame) -> list[tuple[str, str]]:
    """Names and texts of the positions of a batch: one row per shard, whose number the spec fixes."""
    return [(shard_name(spec, r["shard"]), position_text(r["arrived"], r["ms"], r["n"])) for r in positions.collect()]


def _named(spec: ReplicationSpec) -> str:
    # Shards of another count are others, so they are named by it.
    return f"{spec.target}:{spec.keys_prefix}:{spec.shards}:".replace("'", "")


def position_text(arrived: int, ms: int, n: int) -> str:
    """Of fixed width, so that texts compare as positions do."""
    return f"{arrived:019d}-{ms:019d}-{n:019d}"


def position_of(text: str) -> tuple[int, int, int]:
    arrived, ms, n = text.split("-")
    return int(arrived), int(ms), int(n)
