"""Helpers shared by the operators: input frames, written intermediates, streamed groups.

Row identity. Every operator reads only the columns it is told to (id, text, ...), so extra
columns, whatever their names, cannot clash with its working columns.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only; a null text is the empty text."""
    ship_package(df.sparkSession)
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def hold(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once under spark.checkpoint.dir and read it back: cuts the lineage in a
    folder that every executor shares, so a lost executor costs a reread, not a rerun."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    held._held_at = path
    return held


def discard(held: list[DataFrame]) -> None:
    """Delete tables that `hold` wrote and that nothing reads any more."""
    for df in held:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._held_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def rows_per_batch(spark: SparkSession, rows: int) -> contextlib.AbstractContextManager[None]:
    """At most so many rows in an Arrow batch, for jobs run inside whose rows hold long texts."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffles_deleted(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Each query run inside deletes its shuffle files when it ends; otherwise they stay until
    the driver happens to collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


FILTER_BITS = 1 << 23  # 256 rows of 4 KB


def rows_maybe_in(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of `df` whose `key` (a long) is in `wanted`'s, and few others: tested against
    hashed keys in a bitmap of a fixed size, which is broadcast. For a join of few of `df`'s
    rows, before its shuffle; with many more keys than bits it keeps everything."""
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    page, bit = F.bitmap_bucket_number(slot), F.bitmap_bit_position(slot)
    slots = wanted.select(page.alias("_filter_page"), bit.alias("bit"))
    pages = slots.groupBy("_filter_page").agg(F.bitmap_construct_agg("bit").alias("_filter_bits"))
    byte = F.expr("conv(hex(substring(_filter_bits, cast(_row_bit div 8 as int) + 1, 1)), 16, 10)").cast("int")
    is_set = F.call_function("getbit", byte, F.expr("cast(_row_bit % 8 as int)")) == 1
    of_row = df.withColumn("_row_page", page).withColumn("_row_bit", bit)
    found = (F.col("_row_page") == F.col("_filter_page")) & is_set
    return of_row.join(F.broadcast(pages), found, "left_semi").drop("_row_page", "_row_bit")


def tasks(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def stream_groups(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[pa.Table], Iterator[pa.RecordBatch]],
    schema: str,
    order: list[str] = (),
) -> DataFrame:
    """Apply `fn` to every group of `keys`, one group in memory at a time.

    The rows are shuffled by the keys, sorted, and read as Arrow batches; small groups cost
    no Python call through Spark each. `fn` gets one group as a table. Callers bound the
    groups (blocks, salts), so no task holds an unbounded one.
    """
    cols = [df.schema[k].name for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            ks = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in cols), strict=True))
            starts = [0] + [i for i in range(1, len(ks)) if ks[i] != ks[i - 1]] + [len(ks)]
            for a, b in zip(starts, starts[1:], strict=False):
                if last is not None and ks[a] != last:
                    yield from fn(pa.concat_tables(held))
                    held = []
                last = ks[a]
                held.append(t.slice(a, b - a))
        if held:
            yield from fn(pa.concat_tables(held))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def keep_rows(df: DataFrame, text_col: str, keep: Callable) -> DataFrame:
    """The rows of `df`, all columns, for whose text `keep` (list of texts -> mask) is true; a
    null text is passed as the empty text. No shuffle."""
    from liftwise.llm.words import chunks

    k = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(k).to_pylist()]
            for a, b in chunks(texts):
                got = batch.slice(a, b - a).filter(pa.array(keep(texts[a:b])))
                if got.num_rows:
                    yield got

    return df.mapInArrow(run, df.schema)
