"""SQL of the relational targets: one staged batch into its table.

A batch stands in a staging table with the key, the mapped columns and two
flags: ``cf_gone`` (the old row must go) and ``cf_put`` (there is a new row).
So one statement each deletes, upserts and moves the positions, whatever the
size of the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

GONE, PUT = "cf_gone", "cf_put"

Upsert = Callable[["Dialect", str, str, str, Sequence[str]], str]


@dataclass(frozen=True)
class Dialect:
    name: str
    upsert: Upsert
    quotes: tuple[str, str] = ('"', '"')
    #: Makes the table ``{stage}`` from the parts of a query.
    create: str = "CREATE TABLE {stage} AS {select} {source}"

    def quote(self, name: str) -> str:
        """Quoted as Spark's JDBC writer quotes the columns of the staging table."""
        left, right = self.quotes
        return f"{left}{name}{right}"

    def staging(self, table: str, stage: str, pk: str, columns: Sequence[str]) -> str:
        """A staging table without rows, whose columns have the types of the target and take nulls.

        The target stands on the side of an outer join that may be missing, so lengths, character sets and
        precisions are taken over, but no constraint, default or identity.
        """
        listed = [f"t.{c} AS {self.quote(c)}" for c in [pk, *columns]]
        flags = [f"0 AS {self.quote(c)}" for c in (GONE, PUT)]
        return self.create.format(
            stage=stage,
            select=f"SELECT {', '.join(listed + flags)}",
            source=f"FROM {table} s LEFT JOIN {table} t ON 1 = 0 WHERE 1 = 0",
        )

    def delete(self, table: str, stage: str, pk: str) -> str:
        key = self.quote(pk)
        return (
            f"DELETE FROM {table} WHERE {pk} IN "
            f"(SELECT {key} FROM {stage} WHERE {self.quote(GONE)} = 1)"
        )

    def put(self, table: str, stage: str, pk: str, columns: Sequence[str]) -> str:
        return self.upsert(self, table, stage, pk, columns)

    def positions(self, table: str, rows: Sequence[tuple[str, str]], held: Collection[str]) -> list[str]:
        """Move the position of each shard, upwards only; names and values hold no quotes.

        A position that another writer has set in the meantime breaks the transaction by its key if
        it is new, and stays if it is higher.
        """
        return [
            f"UPDATE {table} SET val = '{val}' WHERE id = '{name}' AND val < '{val}'"
            if name in held
            else f"INSERT INTO {table} (id, val) VALUES ('{name}', '{val}')"
            for name, val in rows
        ]


def _selected(d: Dialect, stage: str, pk: str, columns: Sequence[str]) -> str:
    listed = ", ".join(d.quote(c) for c in [pk, *columns])
    return f"SELECT {listed} FROM {stage} WHERE {d.quote(PUT)} = 1"


def _insert(verb: str, d: Dialect, table: str, stage: str, pk: str, columns: Sequence[str]) -> str:
    return f"{verb} INTO {table} ({', '.join([pk, *columns])}) {_selected(d, stage, pk, columns)}"


def _on_duplicate_key(d: Dialect, table: str, stage: str, pk: str, columns: Sequence[str]) -> str:
    sets = ", ".join(f"{c} = VALUES({c})" for c in columns)
    return f"{_insert('INSERT', d, table, stage, pk, columns)} ON DUPLICATE KEY UPDATE {sets}"


def _on_conflict(d: Dialect, table: str, stage: str, pk: str, columns: Sequence[str]) -> str:
    sets = ", ".join(f"{c} = excluded.{c}" for c in columns)
    return f"{_insert('INSERT', d, table, stage, pk, columns)} ON CONFLICT ({pk}) DO UPDATE SET {sets}"


def _or_replace(d: Dialect, table: str, stage: str, pk: str, columns: Sequence[str]) -> str:
    return _insert("INSERT OR REPLACE", d, table, stage, pk, columns)


def _merge(d: Dialect, table: str, stage: str, pk: str, columns: Sequence[str]) -> str:
    sets = ", ".join(f"{c} = s.{d.quote(c)}" for c in columns)
    values = ", ".join(f"s.{d.quote(c)}" for c in [pk, *columns])
    return (
        f"MERGE INTO {table} t USING ({_selected(d, stage, pk, columns)}) s "
        f"ON (t.{pk} = s.{d.quote(pk)}) "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join([pk, *columns])}) VALUES ({values})"
    )


def _merge_with_end(d: Dialect, table: str, stage: str, pk: str, columns: Sequence[str]) -> str:
    return _merge(d, table, stage, pk, columns) + ";"


DIALECTS = {
    d.name: d
    for d in (
        Dialect("mysql", _on_duplicate_key, ("`", "`")),
        Dialect("postgres", _on_conflict),
        Dialect("sqlite", _or_replace),
        Dialect("oracle", _merge),
        Dialect("mssql", _merge_with_end, ("[", "]"), "{select} INTO {stage} {source}"),
        Dialect("snowflake", _merge),
        Dialect("db2", _merge, create="CREATE TABLE {stage} AS ({select} {source}) WITH NO DATA"),
    )
}
