"""Session helpers: scratch tables that cut lineage, checked broadcasts, joins that survive hot keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot from this share of the rows on, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 512
#: Rows of a hot key that a task takes; a key is dealt to as many slices as that makes, SLICES at least.
SLICE_ROWS = 2_000_000
SLICES = 48
#: A side of at most this many rows is broadcast.
BROADCAST_ROWS = 20_000


def session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("tapesh")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def worked_out(df: DataFrame, *columns: str) -> DataFrame:
    """df with these columns behind a generator: what uses them later reads them, and no optimizer rule copies how they came about."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.explode(F.array(F.struct(*columns))).alias("_s")).select(*rest, "_s.*")


def spread(df: DataFrame) -> DataFrame:
    """A scan as it is, or dealt to all cores if it has fewer partitions than there are cores.

    For stages whose work on a row far outweighs moving it. df is a scan with
    at most filters and projections.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


_own_dir: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    Where it is unset a temporary folder serves, but only if driver and
    executors are one process.
    """
    global _own_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="tapesh-")
    return _own_dir


#: Sessions and folders of all scratch tables there are, in the order made.
_roots: list[tuple[SparkSession, str]] = []


class Scratch:
    """Tables written to the shared folder: each cuts the lineage and outlives a lost executor.

    A table is deleted by drop(), at the end of the scratch_scope() that it was
    made in, or when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        _roots.append((spark, self.root))

    def write(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}-{name}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            if path := getattr(table, "_scratch_path", None):
                _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may have ended before the driver
        pass


def _delete_from(place: int) -> None:
    while len(_roots) > place:
        _delete(*_roots.pop())


atexit.register(_delete_from, 0)


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Deletes the scratch tables made within, at its end: for jobs whose results are written by then, such as a batch of a stream."""
    place = len(_roots)
    try:
        yield
    finally:
        _delete_from(place)


def rows_up_to(df: DataFrame, most: int) -> int:
    """The number of rows, or most + 1 if there are more."""
    return df.limit(most + 1).count()


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most so many rows; else as it is."""
    return F.broadcast(df) if rows_up_to(df, most) <= most else df


#: No key of fewer rows is hot, whatever its share.
HOT_ROWS = 50_000


class HotKeys(list):
    """Hot keys, with the slices that their rows are dealt to."""

    slices = SLICES


def hot_values(counts: DataFrame, key: str, n: str, share: float = HOT_SHARE, least: int | None = None, rows: int | None = None) -> list:
    """Keys that hold at least share of all rows counted (and so many rows): at most 1 / share values.

    counts has one row a key, with its number of rows. rows, if given, is a
    bound on all of them: where it is below least, nothing has to be counted.
    """
    least = HOT_ROWS if least is None else least
    if rows is not None and rows < least:
        return []
    total, most = counts.agg(F.sum(n), F.max(n)).first()
    if not total or most < max(least, total * share):
        return []
    found = HotKeys(r[0] for r in counts.where(F.col(n) >= max(least, total * share)).select(key).collect())
    found.slices = max(SLICES, -(-most // SLICE_ROWS))
    return found


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    hot: list | None = None,
    spread: Column | None = None,
    how: str = "inner",
) -> DataFrame:
    """rows joined with lookup, which has one row a key; rows of hot keys are dealt to slices.

    hot are values of keys[0]; spread is what deals the rows of a hot key.
    """
    if not hot:
        return rows.join(lookup, keys, how)
    slices = getattr(hot, "slices", SLICES)
    is_hot = F.coalesce(F.col(keys[0]).isin(list(hot)), F.lit(False))
    dealt = rows.withColumn("_slice", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(slices))).otherwise(F.lit(0).cast("long")))
    copies = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return dealt.join(lookup.withColumn("_slice", F.explode(copies)), [*keys, "_slice"], how).drop("_slice")
