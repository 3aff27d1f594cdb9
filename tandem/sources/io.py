"""Sources and sinks.

Every reader applies the declared schema at the boundary; every writer is a
plain distributed parquet/CSV write. ``FittedStore`` gives the
"fit or reuse by name" behaviour: a fitted table lives under
``<root>/<prefix>_<name>/<table>`` and counts as present once Spark's
``_SUCCESS`` marker is there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem import schemas


def read_likes(spark: SparkSession, path: str) -> DataFrame:
    """Likes parquet -> (uid, item_id, timestamp, is_organic)."""
    return schemas.conform(spark.read.parquet(path), schemas.LIKES)


def read_artist_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Artist mapping parquet with both ids cast to long."""
    return schemas.conform(spark.read.parquet(path), schemas.ARTIST_MAPPING)


def read_target_users(spark: SparkSession, path: str) -> DataFrame:
    """S3: CSV with a header and a ``uid`` column."""
    return (spark.read.option("header", True).schema("uid long").csv(path)
            .where(F.col("uid").isNotNull()))


def users_from_list(spark: SparkSession, uids) -> DataFrame:
    """A small literal user list as a one-column frame."""
    return spark.createDataFrame([(int(u),) for u in uids], schemas.TARGET_USERS)


def write_table(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Overwrite a parquet table."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Lazy read of a written table."""
    return spark.read.parquet(path)


def write_submission(df: DataFrame, path: str) -> None:
    """CSV ``uid,item_ids`` with a header."""
    (schemas.conform(df, schemas.SUBMISSION)
     .write.mode("overwrite").option("header", True).csv(path))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of queries that run meanwhile go as soon as each has ended, not when the driver collects its plan."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def write_scratch(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` computed once into a table of the session's shared scratch folder, read back, and the table's path."""
    from tandem.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, f"table-{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the session's shared scratch folder and read
    it back: survives executor loss, and readers still prune columns."""
    return write_scratch(df)[0]


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a completed Spark write is at ``path`` (``_SUCCESS`` marker)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_table(spark: SparkSession, path: str) -> None:
    """Remove a table that this library wrote (any file system Spark knows)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fingerprint(df: DataFrame) -> str:
    """Column names, row count and an order-free sum of row hashes: one aggregation over the table."""
    total = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    n, h = df.agg(F.count(F.lit(1)), total).first()
    return f"{','.join(df.columns)}:{n}:{h}"


class FittedStore:
    """Fitted tables addressed by ``(prefix, component, table)``.

    By default a name decides alone: what is there is reused. With ``check`` a manifest beside each table keeps what it
    was fitted with (parameters and the input's fingerprint), and other parameters or other data fit it anew.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str | None = None, check: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix or ""
        self.check = check
        self._seen: list = []  # fingerprints of this session's tables: components share one history

    def path(self, component: str, table: str) -> str:
        folder = f"{self.prefix}_{component}" if self.prefix else component
        return f"{self.root}/{folder}/{table}"

    def exists(self, component: str, table: str) -> bool:
        return table_exists(self.spark, self.path(component, table))

    def describe(self, component, history: DataFrame) -> str | None:
        """What a component (generator or source) would be fitted with; null without ``check``."""
        if not self.check:
            return None
        parts = {}
        for name, value in sorted(vars(component).items()):
            if isinstance(value, (bool, int, float, str)):
                parts[name] = value
            elif name == "mapping" and value is not None:
                parts[name] = self._fingerprint(value)
        return json.dumps([component.name, parts, self._fingerprint(history)])

    def _fingerprint(self, df: DataFrame) -> str:
        for known, found in self._seen:
            if known.sameSemantics(df):
                return found
        self._seen.append((df, fingerprint(df)))
        return self._seen[-1][1]

    def usable(self, component: str, table: str, marker: str = "", fitted_with: str | None = None) -> bool:
        """Whether ``table`` is there, complete (``marker`` names the folder that is written last) and, with ``check``,
        fitted with the same."""
        if not self.exists(component, f"{table}/{marker}" if marker else table):
            return False
        if fitted_with is None:
            return True
        return (self.exists(component, f"{table}-manifest")
                and self.spark.read.parquet(self.path(component, f"{table}-manifest")).first()[0] == fitted_with)

    def record(self, component: str, table: str, fitted_with: str | None) -> None:
        """Keep what ``table`` was fitted with; written after the table, so a broken fit leaves no manifest of its own."""
        if fitted_with is not None:
            write_table(self.spark.createDataFrame([(fitted_with,)], "fitted_with string").coalesce(1),
                        self.path(component, f"{table}-manifest"))

    def fit_or_load(self, component: str, table: str, build: Callable[[], DataFrame],
                    force: bool = False, fitted_with: str | None = None) -> DataFrame:
        """Write ``build()`` unless it is already there; return the stored table."""
        p = self.path(component, table)
        if force or not self.usable(component, table, fitted_with=fitted_with):
            if fitted_with is not None:
                delete_table(self.spark, self.path(component, f"{table}-manifest"))
            write_table(build(), p)
            self.record(component, table, fitted_with)
        return read_table(self.spark, p)
