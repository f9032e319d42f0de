"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows that a Python worker turns into objects at a time, where rows hold texts and where they are numbers; an Arrow batch is bounded in bytes besides.
BATCH_ROWS, BATCH_NUMBERS = 256, 20_000
#: Rows that a scan decodes at a time where texts are long, else the default; bytes of a row group that a task holds while it writes.
SCAN_ROWS, SCAN_NUMBERS, ROW_GROUP = 512, 4096, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a local session, whose executors share the machine, gets one of its own where that is unset."""
    there = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if there:
        return there.rstrip("/")
    if not (own := getattr(spark.sparkContext, "_terminus_shared", None)):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        own = f"file://{tempfile.mkdtemp(prefix='terminus-')}"
        spark.sparkContext._terminus_shared = own
    return own


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Session options for what is run inside; the session has its own again afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame, name: str, codec: str = "snappy", rows: int = BATCH_ROWS) -> DataFrame:
    """Write the rows once to the shared folder and read them back: cuts the lineage, survives lost executors.

    rows: of an Arrow batch while that runs; the scan's batch follows it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    written(spark).append(path)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.parquet.columnarReaderBatchSize": SCAN_ROWS if rows <= BATCH_ROWS else SCAN_NUMBERS}):
        df.write.option("parquet.block.size", str(ROW_GROUP)).option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._terminus_path = path
    return out


def written(spark: SparkSession) -> list[str]:
    """The folders that this session has materialized and not yet deleted, in order."""
    return spark.sparkContext.__dict__.setdefault("_terminus_written", [])


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete materialized folders; frames that were made from them can't be read afterwards."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    gone, left = set(paths), written(spark)
    left[:] = [p for p in left if p not in gone]


def dropped(*frames: DataFrame) -> None:
    """Delete the tables of materialized frames that nothing reads any more.

    What was shuffled for them goes too: Spark removes shuffle files when the driver's garbage is collected, which a driver with memory to spare seldom does."""
    for df in frames:
        delete(df.sparkSession, [df._terminus_path])
    gc.collect()
    frames[0].sparkSession._jvm.System.gc()


def gathered(df: DataFrame, source: DataFrame) -> DataFrame:
    """For a scan of the source that streams its rows: four splits to a task, but two tasks a core at least, so fewer files and task commits."""
    spark = df.sparkSession
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.coalesce(min(1_000_000, max(2 * spark.sparkContext.defaultParallelism, -(-size // (4 * split)))))


def sliced(batches, rows: int = BATCH_ROWS):
    """Arrow batches of at most so many rows, whatever the session's setting is."""
    for x in batches:
        for at in range(0, x.num_rows, rows):
            yield x.slice(at, rows)


def free(columns: list[str], *wanted: str) -> list[str]:
    """The names wanted, with as many underscores in front that none is among the columns."""
    taken, front = {c.lower() for c in columns}, ""
    while any((front + w).lower() in taken for w in wanted):
        front += "_"
    return [front + w for w in wanted]


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and the columns named; whatever else the table has stays out of the way."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def computed(docs: DataFrame, inputs: list, compute, fields: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """All rows and columns of a table with more columns: (name, SQL type, Arrow type), from compute(list per input) -> list per field.

    One pass without a shuffle; names must not be among the table's own, `free` finds such."""
    columns, n = docs.columns, len(inputs)
    asked = docs.select("*", *[c.alias(a) for a, c in zip(free(columns, *[f"in_{i}" for i in range(n)]), inputs)])

    def run(batches):
        for x in sliced(batches):
            own = [x.column(len(columns) + i).to_pylist() for i in range(n)]
            out = compute(*own)
            yield pa.RecordBatch.from_arrays([*x.columns[: len(columns)], *[pa.array(v, t) for v, (_, _, t) in zip(out, fields)]], names=[*columns, *[n for n, _, _ in fields]])

    schema = StructType(docs.schema.fields + StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t, _ in fields)).fields)
    return asked.mapInArrow(run, schema)


def batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in schema], schema=schema)


def same_set(df: DataFrame, *columns: str) -> tuple:
    """A fingerprint of a set of rows: two numbers, whatever the number of rows."""
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    return tuple(r)
