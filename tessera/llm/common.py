"""What the operators share: reading tables, cutting lineage, and Arrow stages over texts."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import textscan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`. Where that is unset, one of our own if all run in this process, else an error."""
    context = spark.sparkContext
    held = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not held:
        held = context.getCheckpointDir()
        if not held:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            held = tempfile.mkdtemp(prefix="tessera-")
            atexit.register(shutil.rmtree, held, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(held)
    return held


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, read from the shared folder from now on; Spark removes them when nothing refers to them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def swept(spark: SparkSession) -> None:
    """Let Spark remove shuffle files and checkpoints that nothing refers to; it does so when the driver collects its garbage, which else may be much later."""
    gc.collect()
    spark._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one made of it, that no column of df has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with Spark's own file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a narrow table (an id, a hash, a few words) that are sent to all executors instead of shuffling texts to them.
BROADCAST_ROWS = 500_000


def beside_texts(narrow: DataFrame) -> DataFrame:
    """A narrow table for a join with texts: counted, and broadcast if it has at most `BROADCAST_ROWS` rows; else both sides are shuffled."""
    narrow = checkpointed(narrow)
    return F.broadcast(narrow) if narrow.count() <= BROADCAST_ROWS else narrow


def text_blocks(batch: pa.RecordBatch, limit: int):
    """(first row, UTF-8 texts) of runs of about `limit` bytes of a batch's texts, of which only a run's are copied at a time. A null text is empty."""
    texts = batch.column("text")
    for first, n in textscan.cuts(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), limit):
        yield first, [b"" if t is None else t for t in texts.slice(first, n).cast(pa.large_binary()).to_pylist()]


def over_texts(df: DataFrame, schema: str, work, limit: int = textscan.BLOCK_BYTES) -> DataFrame:
    """Run `work` over blocks of about `limit` bytes of text.

    df has `text` and other columns; work(batch, parts) gets the other columns of a block as a
    record batch and its texts as UTF-8 bytes, and returns columns by name (arrays or lists).
    """
    others = [c for c in df.columns if c != "text"]

    def stage(batches):
        kinds = None
        for batch in batches:
            rest = batch.select(others)
            for first, parts in text_blocks(batch, limit):
                out = work(rest.slice(first, len(parts)), parts)
                if out:
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, kinds[k]) if kinds else pa.array(x) for k, x in enumerate(out.values())], names=list(out))

    return df.mapInArrow(stage, schema)


def kept_texts(df: DataFrame, keep, limit: int = textscan.BLOCK_BYTES) -> DataFrame:
    """The rows of df, all columns as they are, for whose text keep(parts) is true; parts are the UTF-8 texts of a block."""

    def stage(batches):
        for batch in batches:
            for first, parts in text_blocks(batch, limit):
                yield batch.slice(first, len(parts)).filter(pa.array(keep(parts), pa.bool_()))

    return df.mapInArrow(stage, df.schema)


def unsigned_crc32(column) -> F.Column:
    """crc32 of a text's UTF-8 bytes as an unsigned long (null: that of no bytes, 0)."""
    return F.crc32(F.coalesce(column.cast("binary"), F.lit(b"").cast("binary")))


def fold(doc_id, folds: int) -> F.Column:
    """crc32 of doc_id as text modulo `folds` (a null id is the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
