"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: Words of the contracts: runs of anything but space and \t\n\v\f\r.  ``bytes.split()``
#: splits on exactly these six characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def pieces_path(name: str) -> str:
    """Place of a public tokenizer file; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Unlike a cached plan this survives lost executors, and the rows that later
    stages see are the same in each of them.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def release(df: DataFrame) -> None:
    """Delete what ``materialise`` wrote for this frame; nothing may read it any more."""
    spark, path = df.sparkSession, df._written
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    name.getFileSystem(spark._jsc.hadoopConfiguration()).delete(name, True)


def n_tasks(df: DataFrame, least: int = 1) -> int:
    """Shuffle partitions of the session, the unit in which work is dealt out."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class Cache(dict):
    """Bounded memo of a pure function of its key.  When full, its entries become the older
    generation, from which those still in use move back; results never depend on it."""

    def __init__(self, fn, most: int = 400_000):
        super().__init__()
        self.fn, self.most, self.older = fn, most, {}

    def age(self) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key):
        self.age()
        value = self.older.get(key)
        if value is None:
            value = self.fn(key)
        self[key] = value
        return value


_memos: dict[str, object] = {}


def nothing() -> None:
    """What an operator that keeps nothing in a worker has to release."""


def hold(owner: str, release) -> None:
    """Called by an operator before it fills its memo in this worker: what other operators keep,
    their memos and models left from earlier stages in the same process, is released."""
    if owner not in _memos:
        for other in list(_memos):
            _memos.pop(other)()
        give_back()
        _memos[owner] = release


def give_back() -> None:
    """Return freed memory to the system, so that a worker that lives on through many stages holds what
    its present one needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
