"""Change replication on Spark: capture, fold and apply keyed changes."""

from changeflow.plans.recipes import (
    DocumentWriteBehind,
    DocumentWriteThrough,
    WriteBehind,
    WriteThrough,
    document_write_behind,
    document_write_through,
    write_behind,
    write_through,
)
from changeflow.sinks.jdbc import JdbcSink
from changeflow.sinks.merge import MergeSink
from changeflow.sinks.stores import DocumentStoreSink, HashStoreSink, WideColumnSink
from changeflow.sinks.table import TableSink
from changeflow.spec import ReplicationSpec

__all__ = [
    "DocumentStoreSink",
    "DocumentWriteBehind",
    "DocumentWriteThrough",
    "HashStoreSink",
    "JdbcSink",
    "MergeSink",
    "ReplicationSpec",
    "TableSink",
    "WideColumnSink",
    "WriteBehind",
    "WriteThrough",
    "document_write_behind",
    "document_write_through",
    "write_behind",
    "write_through",
]
