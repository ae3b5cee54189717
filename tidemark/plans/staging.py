"""Staged tables in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# The folder of a local application that has no setting.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a local application without the setting gets a temporary folder, one for all
    its calls; a cluster without it is a configuration error, since executors could
    not share the files.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _OWN[application]


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write `df` as a table and read it back.

    Unlike a cached frame this survives lost executors, and unlike a checkpoint it
    has a size Catalyst can see: a join with it is broadcast only when its files are
    under `autoBroadcastJoinThreshold`, and is otherwise a shuffled join whose sides
    are plain scans, which is the shape AQE can split when a key is hot.
    """
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete a staged table nothing reads any more."""
    if not path.startswith(f"{shared_dir(spark)}/tidemark/"):
        raise ValueError(f"{path} is not a staged table")
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def restrict_to_keys(rows: DataFrame, keys_df: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Whole rows whose key is in `keys_df`.

    The distinct keys are staged first.  When few, the wide rows are filtered where
    they are read and never shuffled.
    """
    staged = stage(keys_df.select(*keys).distinct(), "keys")
    if not null_safe:
        return rows.join(staged, keys, "left_semi")
    # Aliases keep the two sides apart when both derive from one table.
    staged = staged.toDF(*[f"__{k}" for k in keys])
    condition = rows[keys[0]].eqNullSafe(staged[f"__{keys[0]}"])
    for key in keys[1:]:
        condition &= rows[key].eqNullSafe(staged[f"__{key}"])
    return rows.join(staged, condition, "left_semi")
