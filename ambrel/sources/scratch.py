"""Tables and folders of a query's own in the shared folder, deleted at the latest when the driver ends."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_home(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; one of its own only under a local master."""
    home = spark.conf.get("spark.checkpoint.dir", None)
    if not home:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        home = tempfile.mkdtemp(prefix="ambrel-")
        spark.conf.set("spark.checkpoint.dir", home)
    return home.rstrip("/")


def new_place(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing stands at."""
    path = f"{shared_home(spark)}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.unregister(_clear_at_exit)
        atexit.register(_clear_at_exit)
    _made.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Delete what stands at the places given out so far; frames that read them are of no use afterwards."""
    while _made:
        place = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None and spark._jsc is not None:
            clear(spark)
    except Exception:  # the session is gone: what is left stays
        pass


def keeper(spark: SparkSession):
    """Writes a table in the shared folder and reads it back: computed once, lineage cut."""

    def keep(df: DataFrame) -> DataFrame:
        path = new_place(spark, "kept")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep
