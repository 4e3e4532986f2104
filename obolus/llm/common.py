"""Parts that several operators of this subpackage share."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# What runs in Python workers travels with the job: they need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules["obolus.llm"])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters that part words in the operators that read `[^\\x20\\x09-\\x0D]+`.
SPACE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text that is not null."""
    t = F.btrim(text, F.lit(SPACE))
    return F.when(t == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(t, r"[\x20\x09-\x0D]+"))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n. A row without an id is in no fold: null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a session on one machine that names none (as in tests) gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="obolus-checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: a lost executor costs a re-read, and later readers
    take only the columns they need. The files go when the cluster clears its checkpoint folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/obolus-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch that are Python objects at a time.
ROWS = 1000


def frames(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, rows: int = ROWS) -> DataFrame:
    """``run`` over frames of at most ``rows`` rows of ``df``, in its tasks. Integers come and go as they are: a
    null beside them does not make them floats, which hold no id above 2 ** 53. What a task has
    learned or read is given back to the machine when it ends, as workers outlive tasks."""
    told = to_arrow_schema(T._parse_datatype_string(schema))

    def in_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get
        parts = (pa.Table.from_batches([batch.slice(i, rows)]).to_pandas(types_mapper=exact) for batch in batches for i in range(0, batch.num_rows, rows))
        try:
            for out in run(parts):
                yield from pa.Table.from_pandas(out, schema=told, preserve_index=False).to_batches()
        finally:
            del parts
            give_back()
    return df.mapInArrow(in_arrow, schema)


def give_back() -> None:
    """Free memory of this process to the system, where its C library can."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def by_batch(docs: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` over frames of ``docs``: memory is that of a batch, a lost task is run again."""
    return frames(docs, lambda parts: (fn(part) for part in parts), schema)


def bounded_sample(labelled: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` of the distinct (doc_id, label) in ``labelled``, labels in turn, each in the order of a hash of
    the ids. Of a label with many rows only those whose hash is among the lowest go on: four
    times ``rows`` are to be expected, and that fewer than ``rows`` are is out of the question. So what
    is ranked together does not grow with the table."""
    h = F.xxhash64("doc_id")
    share = F.least(F.lit(1.0), F.lit(4.0 * rows) / F.col("_n"))
    counts = labelled.groupBy(label).agg(F.count("*").alias("_n")).select(F.col(label).alias("_label"), (F.lit(-2.0 ** 63) + share * 2.0 ** 64).alias("_upto"))
    few = labelled.select("doc_id", label).join(counts, F.col(label) == F.col("_label")).filter(h.cast("double") <= F.col("_upto")).select("doc_id", label)
    order = Window.partitionBy(label).orderBy(h, "doc_id")
    ranked = few.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= rows)
    return ranked.orderBy("_rank", h, label).limit(rows).select("doc_id", label)


def sampled_texts(docs: DataFrame, picked: DataFrame, label: str) -> DataFrame:
    """(doc_id, label, text) of the rows that ``bounded_sample`` picked from (doc_id, label): one for each of them, of an
    id's texts the one of the lowest hash, so there are no more than the sample's bound."""
    on = [c for c in picked.columns if c in docs.columns]
    joined = docs.join(F.broadcast(picked), on).select("doc_id", label, "text")
    return joined.groupBy("doc_id", label).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
