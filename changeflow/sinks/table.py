"""Replication target in a catalog without ``MERGE INTO``: a view over the one of two tables that counts.

A batch merges its net changes into the rows, overwrites the table that does not count with the
result, and then points the view to it. The positions are properties of the view, so one statement of the catalog
makes rows and positions visible together; a try that breaks before it changes nothing.

Each batch rewrites the target. That is the fallback: where the catalog has ``MERGE INTO``, and for targets that
are large beside their batches, use :class:`changeflow.sinks.merge.MergeSink`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators import apply
from changeflow.operators.delivery import WATERMARK
from changeflow.operators.fold import mapped_as_fields
from changeflow.sinks.options import moved_positions, own_positions
from changeflow.spec import ReplicationSpec

#: Property of the view that names the table it reads.
_CURRENT = "changeflow.current"
_SLOTS = ("a", "b")


class TableSink:
    """``mode`` says how an update meets the row that is there.

    ``merge`` sets the mapped columns, ``replace`` replaces the row, ``fields``
    sets the fields of a map column one by one. With ``new_prefix`` rows are named
    ``prefix:pk``. ``table`` is the name of the view; the tables behind it end in ``_a`` and ``_b`` and stand under
    ``location``, or where the catalog puts them. There is one writer per table. What :meth:`read` gave is to
    be used before the second batch after it, and the catalog has to outlive the session for the target to do so.
    """

    transactional = True

    def __init__(
        self,
        table: str,
        spec: ReplicationSpec,
        mode: str = "merge",
        new_prefix: str | None = None,
        location: str | None = None,
    ) -> None:
        if mode not in ("merge", "replace", "fields"):
            raise ValueError(f"unknown mode {mode}")
        self.table = table
        self.spec = spec
        self.mode = mode
        self.new_prefix = new_prefix
        self.location = location

    def create(self, rows: DataFrame) -> None:
        """The table before the first batch, with no position applied yet."""
        for slot, content in zip(_SLOTS, (rows, rows.where(F.lit(False)))):
            place = {} if self.location is None else {"path": f"{self.location.rstrip('/')}/{slot}"}
            content.write.format("parquet").mode("overwrite").options(**place).saveAsTable(self._behind(slot))
        self._point(rows.sparkSession, _SLOTS[0], {})

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.table)

    def read(self, spark: SparkSession) -> DataFrame:
        # Another session, such as that of a stream, may have overwritten files this one has listed.
        spark.catalog.refreshTable(self._behind(self._properties(spark)[_CURRENT]))
        return spark.table(self.table)

    def watermark(self, spark: SparkSession) -> DataFrame:
        """The position of each shard, from the properties of the view."""
        return spark.createDataFrame(own_positions(self.spec, self._properties(spark).items()), WATERMARK)

    def apply(self, net: DataFrame, positions: DataFrame | None) -> None:
        spark = net.sparkSession
        held = self._properties(spark)
        other = _SLOTS[1 - _SLOTS.index(held.pop(_CURRENT))]
        rows = self.read(spark)
        self._merged(rows, net).select(*rows.columns).write.mode("overwrite").insertInto(self._behind(other))
        if positions is not None:
            # Texts of positions compare as positions do.
            held.update((name, max(text, held.get(name, ""))) for name, text in moved_positions(self.spec, positions))
        self._point(spark, other, held)

    def _merged(self, rows: DataFrame, net: DataFrame) -> DataFrame:
        if self.new_prefix is not None:
            net = apply.with_prefix(net, self.new_prefix)
        if self.mode == "fields":
            if "fields" not in net.columns:
                net = net.withColumn("fields", mapped_as_fields(self.spec))
            return apply.merge_fields(rows, net, self.spec.pk)
        merge = apply.upsert_merge if self.mode == "merge" else apply.upsert_replace
        return merge(rows, net, self.spec)

    def _point(self, spark: SparkSession, slot: str, positions: dict[str, str]) -> None:
        properties = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in {**positions, _CURRENT: slot}.items())
        spark.sql(
            f"CREATE OR REPLACE VIEW {_quoted(self.table)} TBLPROPERTIES ({properties}) "
            f"AS SELECT * FROM {_quoted(self._behind(slot))}"
        )

    def _properties(self, spark: SparkSession) -> dict[str, str]:
        if not self.exists(spark):
            raise LookupError(f"there is no table {self.table}, call create() first")
        return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(self.table)}").collect()}

    def _behind(self, slot: str) -> str:
        return f"{self.table}_{slot}"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
