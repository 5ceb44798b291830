"""Where intermediate tables live.

Everything that has to outlive one plan (materialised zones, stream checkpoints, cut lineage) goes
under the folder named by ``spark.checkpoint.dir``, which every executor can reach.
"""

import tempfile
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_zones: dict = {}
_building: dict = {}
_zones_lock = threading.Lock()


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; a fresh temporary one only in local mode with none set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="skygauge-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used, so no run reads the leftovers of another."""
    return f"{shared_dir(spark).rstrip('/')}/skygauge/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: partition layout kept, result survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it from there.

    For a result that several branches of a plan need: each reads only its columns, and a lost
    executor costs a re-read, not the steps before.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_present(spark: SparkSession, path: str):
    """The Parquet table at ``path``, or None when there is none (yet)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_first(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of several zones that exists (labelled rows, else plain features)."""
    for path in paths:
        df = read_if_present(spark, path)
        if df is not None:
            return df
    raise FileNotFoundError(f"none of {paths} exists")


def landed_zone(spark: SparkSession, name: str, build) -> DataFrame:
    """Write ``build()`` once per application as Parquet and read it back from then on.

    Readers then get column pruning and filter pushdown at the scan instead of redoing the
    zone's joins. ``name`` must identify the input folder as well as the zone.
    """
    key = (spark.sparkContext.applicationId, name)
    with _zones_lock:
        building = _building.setdefault(key, threading.Lock())
    with building:  # a second thread waits for the first one's zone
        known = _zones.get(key)
        if known:
            df = read_if_present(spark, known)
            if df is not None:
                return df
        path = fresh_path(spark, name.strip("/").replace("/", "_"))
        build().write.parquet(path)
        _zones[key] = path
        return spark.read.parquet(path)
