"""Runs over a folder of tables: before-image, load, status, rollback, retry.

Tables are Parquet folders that never change; a commit is a file _versions/<n>.json that names every table's folder as of
then. Whoever creates the file of the next number has committed, all tables at once; the file is put there whole and never
over another one, so of two loads at once one comes second. If the first has changed nothing that the second read, the
second's commit is put on top; else it is computed again from the tables as they are now. A lost executor or a failed load
leaves folders that no commit names and every table as it was; vacuum() deletes them.

A run's folder holds manifest.json and the before-image of the rows it touches, one table each.
"""

from __future__ import annotations

import dataclasses
import datetime
import hashlib
import json
import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import relational as R


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_json(spark: SparkSession, path: str, value) -> None:
    """JSON under ``path``: written beside it, then renamed over what is there."""
    aside = f"{path}.{uuid.uuid4().hex}"
    fs, a = _path(spark, aside)
    out = fs.create(a, True)
    out.write(bytearray((json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode()))
    out.close()
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(a, _path(spark, path)[1], options)


def read_json(spark: SparkSession, path: str):
    fs, p = _path(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if fs.exists(p) else None


def put_new(spark: SparkSession, path: str, value) -> bool:
    """JSON under ``path`` unless something is there: written beside it, then linked or renamed, which never replaces."""
    aside = f"{path}.{uuid.uuid4().hex}"
    write_json(spark, aside, value)
    fs, a = _path(spark, aside)
    _, target = _path(spark, path)
    if fs.getScheme() == "file":
        try:
            os.link(a.toUri().getPath(), target.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            fs.delete(a, False)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(a, target, options)
        return True
    except Exception as error:
        if not fs.exists(target):
            raise error
        fs.delete(a, False)
        return False


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def digest_of(*frames: DataFrame) -> str:
    """A digest of frames' rows, in any order: what a run was loaded from."""
    parts = [f.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*f.columns).cast("decimal(20,0)")).alias("s")).first() for f in frames]
    return hashlib.sha256(json.dumps([(p["n"], str(p["s"])) for p in parts]).encode()).hexdigest()


def _at_once(jobs: list[Callable]) -> list:
    """Run jobs of Spark side by side, since each alone may leave executors idle; the first error is raised."""
    with ThreadPoolExecutor(max(1, min(8, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


@dataclasses.dataclass
class Change:
    """What a load does to a table: children of ``parents`` go, then ``rows`` come.

    With a ``key`` a row that is there has ``columns`` (all, if not given) assigned, others are added; without one all are
    added. ``parents`` has the column ``parent``.
    """

    rows: DataFrame
    key: str | None = None
    columns: list[str] | None = None
    parent: str | None = None
    parents: DataFrame | None = None

    def applied(self, old: DataFrame, before: DataFrame) -> DataFrame:
        """The table after the change; ``before`` has its rows that the change may alter. Only these are matched with the new ones."""
        kept, rows = _untouched(old, self.touched()), self.rows.select(*old.columns)
        if self.key is None:
            return kept.unionByName(rows)
        mine = before if self.parent is None else before.join(self.parents.select(self.parent).distinct(), self.parent, "left_anti").select(*old.columns)
        return kept.unionByName(R.upsert(mine, rows, self.key, self.columns or old.columns))

    def touched(self) -> dict[str, DataFrame]:
        """Column -> its values in rows that the change may alter."""
        by_key = {} if self.key is None else {self.key: self.rows.select(self.key).distinct()}
        return by_key if self.parent is None else by_key | {self.parent: self.parents.select(self.parent).distinct()}


def _untouched(df: DataFrame, touched: dict[str, DataFrame]) -> DataFrame:
    for c, values in touched.items():
        df = df.join(values, c, "left_anti").select(*df.columns)
    return df


def _touched(df: DataFrame, touched: dict[str, DataFrame]) -> DataFrame:
    out, before = None, {}
    for c, values in touched.items():  # each row once, by the first column that has it
        part = _untouched(df, before).join(values, c, "left_semi").select(*df.columns)
        out, before = part if out is None else out.unionByName(part), before | {c: values}
    return out


class Store:
    """Versioned tables under ``home``."""

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home.rstrip("/")

    def snapshot(self) -> tuple[int, dict]:
        """The number of the last commit (0: none) and, by table, its folder and the commit that last changed it."""
        n = max((int(x[:-5]) for x in names_in(self.spark, f"{self.home}/_versions") if x.endswith(".json")), default=0)
        return n, read_json(self.spark, f"{self.home}/_versions/{n:012d}.json") if n else {}

    def version(self, table: str) -> int:
        return self.snapshot()[1].get(table, {"version": 0})["version"]

    def _at(self, tables: dict, table: str) -> DataFrame:
        if table not in tables:
            raise ValueError(f"no table {table}")
        return self.spark.read.parquet(f"{self.home}/{tables[table]['folder']}")

    def read(self, table: str, deleted: bool = True) -> DataFrame:
        """A table as of now; without rows marked deleted if not ``deleted``."""
        df = self._at(self.snapshot()[1], table)
        return df if deleted or "deleted" not in df.columns else R.present(df)

    def commit(self, make: Callable[[Callable[[str], DataFrame]], dict[str, DataFrame | str]], tries: int = 20) -> int:
        """Write what ``make(read)`` gives, table -> rows or the name of a folder that has them, as one commit; its number.

        ``make`` is called again, with the tables as they are then, if another commit has changed what it read or writes.
        """
        for _ in range(tries):
            n, tables = self.snapshot()
            seen: dict[str, DataFrame] = {}

            def read(table: str) -> DataFrame:
                if table not in seen:
                    seen[table] = self._at(tables, table)
                return seen[table]

            made = make(read)
            written = {table: df if isinstance(df, str) else f"{table}/{uuid.uuid4().hex}" for table, df in made.items()}
            _at_once([lambda df=df, t=table: df.write.parquet(f"{self.home}/{written[t]}") for table, df in made.items() if not isinstance(df, str)])
            now, base = n, tables
            while all(base.get(t) == tables.get(t) for t in {*seen, *written}):
                value = base | {t: {"folder": f, "version": now + 1} for t, f in written.items()}
                if put_new(self.spark, f"{self.home}/_versions/{now + 1:012d}.json", value):
                    return now + 1
                now, base = self.snapshot()
        raise RuntimeError(f"other loads came first {tries} times")

    def write(self, table: str, df: DataFrame) -> None:
        self.commit(lambda read: {table: df})

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete table folders that none of the last ``keep`` commits names. No load may be under way."""
        n = self.snapshot()[0]
        last = [read_json(self.spark, f"{self.home}/_versions/{k:012d}.json") for k in range(max(1, n - keep + 1), n + 1)]
        named, gone = {t["folder"] for v in last for t in v.values()}, []
        for table in {t for v in last for t in v}:
            for folder in names_in(self.spark, f"{self.home}/{table}"):
                if f"{table}/{folder}" not in named:
                    fs, p = _path(self.spark, f"{self.home}/{table}/{folder}")
                    fs.delete(p, True)
                    gone.append(f"{table}/{folder}")
        return sorted(gone)

    def require(self, columns: dict[str, list[str]]) -> None:
        """Tables and columns that must be there; all that lack are named."""
        lacking, tables = [], self.snapshot()[1]
        for table, names in columns.items():
            have = set(self._at(tables, table).columns) if table in tables else None
            lacking += [table] if have is None else [f"{table}.{c}" for c in names if c not in have]
        if lacking:
            raise ValueError("missing: " + ", ".join(lacking))

    # runs

    def manifest(self, run: str) -> dict:
        found = read_json(self.spark, f"{self.home}/_runs/{run}/manifest.json")
        if found is None:
            raise ValueError(f"no run {run}")
        return found

    def latest(self) -> str | None:
        """The last run that succeeded."""
        return (read_json(self.spark, f"{self.home}/_runs/latest.json") or {"run": None})["run"]

    def _mark(self, m: dict, status: str, **more) -> dict:
        m = m | {"status": status, f"{status}At": datetime.datetime.now(datetime.UTC).isoformat()} | more
        write_json(self.spark, f"{self.home}/_runs/{m['run']}/manifest.json", m)
        return m

    def load(self, name: str, changes, parent: str | None = None, children: dict[str, str] | None = None, inputs: str | None = None) -> dict:
        """Apply ``changes`` to their tables as one commit and a run; returns its manifest.

        ``changes`` is table -> Change, or a function of ``read`` that gives such; it may refuse by raising, and is asked
        again if another load has come between. A change may also be (key, columns to assign, rows), where a table in
        ``children`` (table -> parent column) has all children of the parents in the rows replaced. ``inputs`` is a digest of
        what is loaded, of the rows if not given. The rows that the run touches are kept before it commits; a failure is
        marked and raised, with all tables as they were.
        """
        children = children or {}

        def asked(read) -> dict[str, Change]:
            found = changes(read) if callable(changes) else changes
            as_change = lambda t, c: c if isinstance(c, Change) else Change(c[2], None, None, children[t], c[2]) if t in children else Change(c[2], c[0], c[1])
            return {t: as_change(t, c) for t, c in found.items()}

        stamp = datetime.datetime.now(datetime.UTC).strftime("%Y%m%dT%H%M%S_%f")
        run = f"{name}_{stamp}_{hashlib.sha256((name + (inputs or stamp)).encode()).hexdigest()[:8]}"
        m = self._mark({"run": run, "name": name, "parent": parent, "inputs": inputs, "tables": {}}, "started")

        def make(read):
            nonlocal m
            attempt, found = uuid.uuid4().hex, asked(read)
            old = {table: read(table) for table in found}
            m["tables"] = {t: {"home": f"_runs/{run}/{attempt}/{t}", "key": c.key, "columns": c.columns, "parent": c.parent} for t, c in found.items()}
            home = lambda t, what: f"{self.home}/{m['tables'][t]['home']}/{what}"
            jobs = [lambda t=t, c=c: c.rows.select(*old[t].columns).write.parquet(home(t, "new")) for t, c in found.items()]
            jobs += [lambda t=t, c=c: c.parents.select(c.parent).distinct().write.parquet(home(t, "parents")) for t, c in found.items() if c.parent is not None]
            _at_once(jobs)
            kept = {t: self._change(at) for t, at in m["tables"].items()}
            _at_once([lambda t=t, c=c: _touched(old[t], c.touched()).write.parquet(home(t, "before")) for t, c in kept.items()])
            before = {t: self.spark.read.schema(old[t].schema).parquet(home(t, "before")) for t in kept}
            out = {t: c.applied(old[t], before[t]).select(*old[t].columns) for t, c in kept.items()}
            m = self._mark(m, "snapshotted")
            return out

        try:
            m["commit"] = self.commit(make)
        except Exception as error:
            self._mark(m, "failed", error=str(error)[:1000])
            raise
        if inputs is None:
            m["inputs"] = digest_of(*[self._change(at).rows for at in m["tables"].values()])
        write_json(self.spark, f"{self.home}/_runs/latest.json", {"run": run})
        return self._mark(m, "succeeded")

    def _change(self, at: dict) -> Change:
        """A run's change of a table as it was kept."""
        read = lambda what: self.spark.read.parquet(f"{self.home}/{at['home']}/{what}")
        return Change(read("new"), at["key"], at["columns"], at["parent"], read("parents") if at["parent"] else None)

    def later_runs(self, run: str) -> list[str]:
        """Runs that stand, came after ``run`` and touch rows that it touched."""
        m, found = self.manifest(run), []
        for other in names_in(self.spark, f"{self.home}/_runs"):
            o = read_json(self.spark, f"{self.home}/_runs/{other}/manifest.json") if other != "latest.json" else None
            if o is None or o["status"] != "succeeded" or o["commit"] <= m["commit"]:
                continue
            for table, at in m["tables"].items():
                if table in o["tables"]:
                    mine, theirs = self._change(at).touched(), self._change(o["tables"][table]).touched()
                    if any(not mine[c].join(theirs[c], c, "left_semi").isEmpty() for c in mine if c in theirs):
                        found.append(other)
                        break
        return sorted(found)

    def rollback(self, run: str, force: bool = False) -> dict:
        """Put the before-image back, all tables at once.

        A table that no later commit changed, and whose folder from before the run is still there, gets that folder again; of
        the others the rows that the run touched are replaced.
        Only a succeeded run can be rolled back, and only before later runs on the same rows are, unless ``force`` is given:
        their rows then get the values from before this run too.
        """
        m = self.manifest(run)
        if m["status"] != "succeeded":
            raise ValueError(f"run {run} is {m['status']}")
        if not force and (later := self.later_runs(run)):
            raise ValueError(f"later runs touch the same rows: {', '.join(later)}")

        former = read_json(self.spark, f"{self.home}/_versions/{m['commit'] - 1:012d}.json") or {}

        def make(read):
            out, now = {}, self.snapshot()[1]
            for table, at in m["tables"].items():
                if now[table]["version"] == m["commit"] and "_SUCCESS" in names_in(self.spark, f"{self.home}/{former[table]['folder']}"):
                    read(table)  # so that the commit is made again if the table changes meanwhile
                    out[table] = former[table]["folder"]
                    continue
                old, before = read(table), self.spark.read.parquet(f"{self.home}/{at['home']}/before")
                out[table] = _untouched(old, self._change(at).touched()).unionByName(before.select(*old.columns))
            return out

        return self._mark(m, "rolled_back", rollbackCommit=self.commit(make))

    def retry(self, run: str, changes=None, children: dict[str, str] | None = None) -> dict:
        """Load again what failed, as a run of its own that names the failed one.

        Without ``changes`` what the failed run had kept is loaded; that it is all there is asked for first.
        """
        m = self.manifest(run)
        if m["status"] != "failed":
            raise ValueError(f"run {run} is {m['status']}")
        if changes is None:
            lost = [t for t, at in m["tables"].items() if "_SUCCESS" not in names_in(self.spark, f"{self.home}/{at['home']}/new")]
            if lost or not m["tables"]:
                raise ValueError("what the run was to load is not there: " + ", ".join(lost or ["no table"]))
            changes = {t: self._change(at) for t, at in m["tables"].items()}
        return self.load(m["name"], changes, run, children, m["inputs"])

    def tracked(self, run: str) -> dict[str, DataFrame]:
        """Table -> the keys (parents, without a key) of the rows that the run loaded."""
        changes = {t: self._change(at) for t, at in self.manifest(run)["tables"].items()}
        return {t: c.rows.select(c.key or c.parent).distinct() for t, c in changes.items()}

    def status(self, run: str) -> DataFrame:
        """table, tracked and missing: how many of the run's keys there are, and how many the tables now lack."""
        parts = []
        for table, keys in self.tracked(run).items():
            (by,) = keys.columns
            there = self.read(table).select(by).distinct().withColumn("there", F.lit(1))
            parts.append(keys.join(there, by, "left").agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("tracked"), F.count_if(F.col("there").isNull()).alias("missing")))
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out
