"""What several operators of this folder share: shared storage, words and hashes."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these bytes: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes that cut() writes before it asks for unused shuffle files to go.
RELEASE_BYTES = 1 << 24
_written = 0


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where it is unset and Spark runs in this one process (tests) a temporary folder takes its place.
    """
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='tidebar-')}"
        sc.setCheckpointDir(at)
    return at


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again.

    The result has no lineage, so a lost executor costs nothing but a read. Where tables of some size were
    written before, shuffle files that no plan needs any more are released first.
    """
    global _written
    spark = df.sparkSession
    if _written > RELEASE_BYTES:
        _written = 0
        release(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidebar_path = path
    where, files = _file_system(spark, path)
    _written += files.getContentSummary(where).getLength()
    return out


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop(*tables: DataFrame) -> None:
    """Delete tables made by cut() that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_tidebar_path", None):
            where, files = _file_system(t.sparkSession, path)
            files.delete(where, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner find shuffles and broadcasts that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def column(name: str) -> Column:
    """The column of that very name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns of df in one struct: what an operator adds next to it can't clash with their names."""
    return F.struct(*[column(c).alias(c) for c in df.columns])


def unfold(df: DataFrame, held: str, result: list[str]) -> DataFrame:
    """The fields of the struct column ``held`` and the columns ``result``, which replace fields of the same name."""
    fields = [f.name for f in df.schema[held].dataType.fields]
    return df.select(*[F.col(held).getField(n).alias(n) for n in fields if n not in result], *result)


def text_of(name: str = "text") -> Column:
    """The text as bytes (UTF-8); null counts as empty."""
    return F.coalesce(column(name), F.lit("")).cast("binary")


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def share(key: Column, part: float | Column) -> Column:
    """True for a fixed pseudo-random part of the rows, by a hash of key."""
    return F.pmod(F.xxhash64(key, F.lit("share")), F.lit(1 << 30)) < (F.lit(part) if isinstance(part, float) else part) * F.lit(float(1 << 30))


# Batches of sorted rows --------------------------------------------------------------------------


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by key, cut between groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if last or (held and held[-1][key][-1].as_py() != keys[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks().to_batches()[0] if held or last else batch
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


# Hashes of words, in NumPy ------------------------------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GAP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64, over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GAP)
_BYTE[IS_SPACE] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64, n of them at least."""
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 2 * len(_powers), 64), 0xD6E8FEB86659FD93, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def word_starts(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text (bytes) begin and end."""
    if not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~IS_SPACE[b]
    turn = np.flatnonzero(np.diff(solid.view(np.int8), prepend=0, append=0))
    return turn[::2], turn[1::2]


def word_hashes(b: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word of a text (bytes); with lower, A-Z count as a-z."""
    starts, _ = word_starts(b)
    if not len(starts):
        return np.zeros(0, np.uint64)
    head = int(starts[0])
    value = (_BYTE_LOWER if lower else _BYTE)[b[head:]]
    starts = starts - head
    lengths = np.diff(starts, append=len(value))
    at = np.arange(len(value)) - np.repeat(starts, lengths)
    return mix(np.add.reduceat(value * powers(int(lengths.max()))[at], starts))
