"""Deletes that follow references between a store's tables: dry-run counts first, then one commit that can be rolled back.

References are (child table, column, parent table); every table has the key ``id``. Deleting a row deletes the rows that refer
to it, and those that refer to them. Tables are taken in levels, found by rounds over the references: a table's doomed rows
are known once those of all its parents are, each by one semi-join. Only references of a table to itself are followed round by
round, until no row is added. A cycle through several tables has no levels and is refused.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runs import Change, Store

Reference = tuple[str, str, str]


def referring(references: list[Reference], selected: set[str], preserve: set[str] = frozenset()) -> set[str]:
    """``selected`` and all tables that refer to them, through any number of others, without those to preserve."""
    found = set(selected) - set(preserve)
    while more := {child for child, _, parent in references if parent in found and child not in preserve} - found:
        found |= more
    return found


def levels(tables: set[str], references: list[Reference]) -> list[list[str]]:
    """Tables so that every table comes after those it refers to; each round takes those whose parents are all taken."""
    edges = {(c, p) for c, _, p in references if c != p and c in tables and p in tables}
    out, left = [], set(tables)
    while left:
        ready = sorted(t for t in left if not any(c == t and p in left for c, p in edges))
        if not ready:
            raise ValueError("tables refer to each other in a circle: " + ", ".join(sorted(left)))
        out.append(ready)
        left -= set(ready)
    return out


def counts(read, tables) -> DataFrame:
    """(table, n): rows of each table, in one plan."""
    return reduce(DataFrame.union, [read(t).agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("n")) for t in tables])


def doomed(read, table: str, ids: DataFrame, references: list[Reference], keep) -> dict[str, DataFrame]:
    """Table -> ids of the rows that go when the rows ``ids`` of ``table`` go; deepest references first."""
    tables, found = referring(references, {table}), {}
    for name in (t for level in levels(tables, references) for t in level):
        rows = read(name)
        parts = [ids.select("id").join(rows.select("id"), "id", "left_semi")] if name == table else []
        parts += [rows.join(found[p].select(F.col("id").alias(column)), column, "left_semi").select("id") for c, column, p in references if c == name and p != name and p in found]
        now = reduce(DataFrame.union, parts).distinct()
        own = [column for c, column, p in references if c == p == name]
        if own:
            now = fresh = keep(now)
            while not fresh.isEmpty():
                more = reduce(DataFrame.union, [rows.join(fresh.select(F.col("id").alias(column)), column, "left_semi").select("id") for column in own])
                fresh = keep(more.distinct().join(now, "id", "left_anti"))
                now = now.union(fresh)
        found[name] = keep(now)
    return dict(reversed(found.items()))


def _deleted(read, ids: dict[str, DataFrame]) -> dict[str, Change]:
    return {t: Change(read(t).limit(0), None, None, "id", rows) for t, rows in ids.items()}


def _told(ids: dict[str, DataFrame]) -> dict[str, int]:
    """Rows that go by table, counted in one plan."""
    return {r["table"]: r["n"] for r in counts(lambda t: ids[t], ids).collect()}


def cascade(store: Store, table: str, ids: DataFrame, references: list[Reference], keep, execute: bool = False, known: dict | None = None) -> dict:
    """Rows by table that go with the rows ``ids`` of ``table``; they do go, as the run ``run``, only if told to ``execute``.

    ``known``, a dict given to a dry run and then to the same delete, keeps what was found; it is used if no table has changed.
    """
    tables = referring(references, {table})
    if not execute:
        snapshot = store.snapshot()[1]
        gone = doomed(lambda t: store._at(snapshot, t), table, ids, references, keep)
        rows = _told(gone)
        if known is not None:
            known.update(at={t: snapshot[t] for t in tables}, gone=gone, rows=rows)
        return {"dryRun": True, "rows": dict(rows)}
    rows = {}

    def changes(read):
        now = store.snapshot()[1]  # never older than what ``read`` reads
        same = bool(known) and known["at"] == {t: now[t] for t in tables}
        gone = known["gone"] if same else doomed(read, table, ids, references, keep)
        rows.clear()
        rows.update(known["rows"] if same else _told(gone))
        return _deleted(read, gone)

    run = store.load(f"delete-{table}", changes)
    return {"dryRun": False, "rows": rows, "run": run["run"]}


def keep_only(store: Store, table: str, kept: DataFrame, references: list[Reference], keep, within=None, execute: bool = False) -> dict:
    """Delete all rows of ``table`` whose id is not among ``kept``, of those that satisfy ``within`` if given, and what refers to them."""
    rows = store.read(table)
    others = (rows if within is None else rows.where(within)).join(kept.select("id"), "id", "left_anti").select("id")
    return cascade(store, table, others, references, keep, execute)


def without_children(store: Store, table: str, references: list[Reference], keep, execute: bool = False) -> dict:
    """Delete the rows of ``table`` that no row of any other table refers to."""
    rows = store.read(table).select("id")
    for child, column, parent in references:
        if parent == table and child != table:
            rows = rows.join(store.read(child).select(F.col(column).alias("id")), "id", "left_anti")
    return cascade(store, table, rows, references, keep, execute)


def clear_tables(store: Store, selected: set[str], references: list[Reference], preserve: set[str] = frozenset(), execute: bool = False) -> dict:
    """Empty ``selected`` and all tables that refer to them, but those to preserve; counts alone unless told to ``execute``."""
    tables = [t for level in reversed(levels(referring(references, selected, preserve), references)) for t in level]
    snapshot = store.snapshot()[1]
    before = {r["table"]: r["n"] for r in counts(lambda t: store._at(snapshot, t), tables).collect()}
    out = {"dryRun": not execute, "tables": tables, "rows": before, "totalRows": sum(before.values())}
    if execute:
        run = store.load("clear", lambda read: {t: Change(read(t).limit(0), None, None, "id", read(t).select("id")) for t in tables})
        out |= {"run": run["run"], "remainingRows": sum(r["n"] for r in counts(store.read, tables).collect()), "preserved": {t: store.read(t).count() for t in sorted(preserve) if t in snapshot}}
    return out
