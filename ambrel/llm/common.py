"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir`` that driver and executors share.

    Only a local master may fall back to a temporary folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="ambrel-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


#: Intermediate tables that nobody has deleted yet.
_made: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder; what stands there is deleted by clear(), at the latest when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.unregister(_clear_at_exit)
        atexit.register(_clear_at_exit)
    _made.append(path)
    return path


def made_so_far() -> int:
    return len(_made)


def clear(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete the intermediate tables made after the first ``since``; frames that read them are of no use afterwards."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _made[since:]:
        if path not in keep:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
            _made.remove(path)


def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None and spark._jsc is not None:
            clear(spark)
    except Exception:  # the session is gone: what is left stays
        pass


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


HOT = 1000


def join_skewed(left: DataFrame, right: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """The inner join on ``key``, unique in ``right``, whose column ``n`` counts the rows of ``left`` with that key.

    Keys that more than one in HOT of the ``total`` rows have, fewer than HOT by this proof, are broadcast; of the others
    none is hot, and they are shuffled at every size: a table that grows with the input is not broadcast while it is small.
    """
    hot = F.col(n) * HOT > total
    some = F.broadcast(right.where(hot))
    rest = left.join(F.broadcast(right.where(hot).select(key)), key, "left_anti")
    return left.join(some, key).union(rest.join(right.where(~hot).hint("merge"), key))


def shielded(docs: DataFrame, used: list[str], run) -> DataFrame:
    """``run(docs)`` with the columns of ``docs``: those not ``used`` have names of their own meanwhile, so none clashes."""
    away = {c: f"__c{i}" for i, c in enumerate(docs.columns) if c not in used}
    named = docs.select(*[F.col(f"`{c}`").alias(away.get(c, c)) for c in docs.columns])
    return run(named).select(*[F.col(f"`{away.get(c, c)}`").alias(c) for c in docs.columns])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def in_pieces(texts: list[str], limit: int):
    """(from, to) ranges of ``texts`` of about ``limit`` characters, one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
