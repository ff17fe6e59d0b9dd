"""Small helpers of the operators: tables, shared folders, memos and split numbering."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows in an Arrow batch. Texts are long, and a batch is held in memory.
BATCH_ROWS = 1000
#: Bits of the map by which rows are set apart before a join by id.
FILTER_BITS = 1 << 24
#: Applications whose executors have this package.
_SHIPPED: set[str] = set()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session without the setting, as in tests, gets a temporary folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="parley-llm-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """The rows, written to the shared folder and read again: the lineage ends here."""
    folder = shared_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of the application, whose paths may lack it."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    # executors fetch it from the driver whenever they start, so it stays until the driver ends
    folder = tempfile.mkdtemp(prefix="parley-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / f"{root.name}-{application}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def prepare_workers(spark: SparkSession) -> None:
    """Give Python workers this package, and keep Arrow batches of texts small.

    A smaller batch size of the caller stays.
    """
    _ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_filter(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows in two parts: those whose ``doc_id`` may be among ``ids``, and those surely not.

    A bit map of ``FILTER_BITS`` hashed ids, kept as a table of at most ``FILTER_BITS / 64`` rows,
    is broadcast; its size does not depend on the input. So only the first part needs an exact
    join, and the second is not shuffled. With very many ids all rows come to the first.
    """

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(FILTER_BITS))

    def bit(column: str) -> Column:
        return F.expr(f"shiftleft(1L, cast(pmod(xxhash64(cast({column} AS bigint)), 64L) AS int))")

    words = ids.groupBy((place("doc_id") / 64).cast("int").alias("__filter_word")).agg(F.bit_or(bit("doc_id")).alias("__filter_bits"))
    joined = rows.join(F.broadcast(stored(words)), (place("doc_id") / 64).cast("int") == F.col("__filter_word"), "left")
    hit = F.coalesce(F.col("__filter_bits").bitwiseAND(bit("doc_id")) != 0, F.lit(False))
    return joined.where(hit).select(rows["*"]), joined.where(~hit).select(rows["*"])


def numbered(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], name: str
) -> DataFrame:
    """Gapless numbers from 0 within each group, without a task for a whole group.

    Rows are numbered within (group, bucket) and moved by the rows of the smaller buckets of
    the group. The frame is read twice, so it should be stored or cheap.
    """
    keys = [*group, bucket]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn("_place", place)
    joined = ranked.join(starts, keys)
    return joined.withColumn(name, F.col("_start") + F.col("_place") - 1).drop("_place", "_start")


class Memo(dict):
    """Values by key, made when first asked for; holds two generations of ``most`` keys.

    Keys longer than ``longest`` are made each time.
    """

    def __init__(self, make: Callable, most: int = 600_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
