"""Helpers shared by the operators: tables, scratch tables, words, hashing."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# The word pattern every operator shares: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a scratch folder is made only for a single-machine
    master (tests); on a cluster the missing setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not root:
        master = sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared root, removed when the driver's JVM ends."""
    path = f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def free_shuffles(spark: SparkSession, wait: float = 0.0) -> None:
    """Ask for the garbage collection that lets Spark remove the files of
    shuffles nothing refers to. Right after a write its listeners may still
    refer to them: once more after ``wait`` seconds is surer."""
    time.sleep(wait)
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage: what follows replays from the table after a lost executor
    and sees real sizes, so AQE chooses joins by measurement. The shuffles
    behind the table are no longer needed then; Spark removes their files once
    the driver has collected its garbage, which is asked for here, as disks
    would else hold every shuffle of the job at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    free_shuffles(spark)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch = path
    return back


def discard(*tables: DataFrame) -> None:
    """Remove tables of :func:`written` that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return memory that this process has freed, but holds for reuse, to the
    system (where the C library can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function for ``mapInArrow``, in a worker that gives back what
    earlier tasks and this one have freed: Spark's Python workers live on from
    stage to stage, and would else each hold the most that any stage took."""

    def tidy(batches: Iterator) -> Iterator:
        give_back()
        yield from run(batches)
        gc.collect()
        give_back()

    return tidy


def shrink_heaps(spark: SparkSession) -> None:
    """Have executors collect their garbage, after which their JVMs return the
    unused part of the heap to the system: it grows to its limit in a long job
    and would else stay there, beside the memory of Python workers. One task for
    each core, which Spark deals out over all free executors."""
    n = spark.sparkContext.defaultParallelism
    collected = spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc")).alias("done"))
    collected.write.format("noop").mode("overwrite").save()


def bit_filter(keys: DataFrame, bits: int) -> bytes:
    """A two-hash Bloom filter of the 64-bit numbers in column ``key``: 2^bits
    bits whatever their number, so what is collected and sent is bounded."""
    mask = (1 << bits) - 1
    at = F.explode(F.array(F.col("key").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("key", 32).bitwiseAND(F.lit(mask))))
    words = keys.select(at.alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("v")
    )
    got = words.toArrow()
    out = np.zeros(max(1, 1 << (bits - 6)), np.int64)
    out[got.column("w").to_numpy()] = got.column("v").to_numpy()
    return out.tobytes()


def in_filter(words: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Which of ``keys`` (uint64) may be in the filter ``words`` (uint64)."""
    mask = np.uint64((1 << bits) - 1)
    hit = np.ones(keys.shape, bool)
    for at in (keys & mask, (keys >> np.uint64(32)) & mask):
        hit &= (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return hit


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (fixed fold rule)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names: extra columns of the
    input, whatever they are called, cannot clash with those added later."""
    return df.select(*[df[src].alias(dst) for dst, src in columns.items()])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it (columns are told
    apart without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
