"""What one replication consists of: prefix, mapping, target and delivery."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The control field, its operation characters and the defaults.
OP_FIELD = "#"
DELETE_REPLICATE = "~"
DELETE_LOCAL = "-"
UPDATE_REPLICATE = "="
UPDATE_LOCAL = "+"
OPERATIONS = ("~", "-", "=", "+")
LOCAL_OPERATIONS = ("-", "+")
RESERVED_PREFIX = "_"
HASH_EVENTS = ("hset", "hmset", "del", "change")
STAGED_EVENTS = ("hset", "hmset")
DOCUMENT_EVENTS = (
    "json.set",
    "json.del",
    "json.strappend",
    "json.arrinsert",
    "json.arrappend",
    "json.arrtrim",
    "json.arrpop",
    "change",
    "del",
)
DOCUMENT_FIELD = "doc"
DEFAULT_BATCH = 100
DEFAULT_DURATION_MS = 100
DEFAULT_RETRY_SECONDS = 5
ACK_TTL_SECONDS = 3600


@dataclass(frozen=True)
class ReplicationSpec:
    """One prefix of a source, replicated to one target table.

    ``mappings`` goes from source field to target column; a source field that
    starts with ``_`` is ignored. ``types`` gives the types of the target columns and of the
    key (string where absent). ``max_retries`` ends the attempts to write a batch; None goes on
    until the target is back. ``shard_by`` turns the pk column into a shard number
    in ``[0, shards)``. ``whole_hashes`` copies every plain field under its own
    name, without a mapping, and no deletes.
    """

    target: str
    pk: str
    keys_prefix: str
    mappings: dict[str, str] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)
    event_types: tuple[str, ...] = HASH_EVENTS
    transform: Callable[[DataFrame], DataFrame] | None = None
    shards: int = 16
    shard_by: Callable[[Column], Column] | None = None
    whole_hashes: bool = False
    exactly_once: bool = True
    batch: int = DEFAULT_BATCH
    duration_ms: int = DEFAULT_DURATION_MS
    retry_seconds: float = DEFAULT_RETRY_SECONDS
    max_retries: int | None = None

    def __post_init__(self) -> None:
        if not self.keys_prefix:
            raise ValueError("keys_prefix must not be empty")
        if self.shards < 1 or self.batch < 1:
            raise ValueError("shards and batch must be positive")
        if self.whole_hashes and self.mappings:
            raise ValueError("whole hashes take no mapping")
        columns = list(self.columns)
        if len(set(columns)) != len(columns):
            raise ValueError("two source fields map to one target column")
        if any(not isinstance(t, str) for t in self.types.values()):
            raise ValueError("types are names of types")
        if self.pk in columns:
            raise ValueError(f"column {self.pk} is the primary key, it takes no mapping")

    @property
    def fields(self) -> dict[str, str]:
        """The mappings that are in force: source field to target column."""
        return {s: c for s, c in self.mappings.items() if not s.startswith(RESERVED_PREFIX)}

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.fields.values())

    def type_of(self, column: str) -> str:
        return self.types.get(column, "string")

    @property
    def target_schema(self) -> T.StructType:
        ddl = [f"`{self.pk}` string"] + [f"`{c}` {self.type_of(c)}" for c in self.columns]
        return T.StructType.fromDDL(", ".join(ddl))

    def shard(self, pk: Column) -> Column:
        """Shard number of a primary key."""
        if self.shard_by is not None:
            given = self.shard_by(pk).cast("int")
            # Null, and numbers out of range, go to a shard all the same.
            return F.pmod(F.coalesce(given, F.lit(0)), F.lit(self.shards))
        return F.pmod(F.xxhash64(pk), F.lit(self.shards)).cast("int")
