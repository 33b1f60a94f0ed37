"""What the operators of this subpackage share: input columns, scratch tables, byte-level words."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes with A-Z lower-cased and all others as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the operators read, under fixed names; a null text is the empty text."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as spark.checkpoint.dir names it. Where that is unset, a local session has a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.ledgerwatch.scratch", "")
    if not base:
        if not spark.conf.get("spark.master", "").startswith(("local[", "local")) or spark.conf.get("spark.master", "").startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        base = "file://" + tempfile.mkdtemp(prefix="ledgerwatch-")
        spark.conf.set("spark.ledgerwatch.scratch", base)
    return base.rstrip("/")


class Scratch:
    """Written tables of one job, in a database of its own in the shared folder: lineage ends at each, so a lost executor costs a read.

    Tables are removed as soon as nothing needs them: by `drop`, or all but the result by `only`.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.database, self.tables = spark, f"scratch_{uuid.uuid4().hex}", {}
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{shared_dir(spark)}/{self.database}'")

    def write(self, df: DataFrame, codec: str = "zstd", bucket: str = "", buckets: int = 1) -> DataFrame:
        """The same rows, read back."""
        name = f"{self.database}.t{len(self.tables)}"
        writer = df.write.option("compression", codec)
        (writer.bucketBy(buckets, bucket) if bucket else writer).saveAsTable(name)
        out = self.spark.table(name)
        self.tables[name] = out
        return out

    def drop(self, *frames: DataFrame) -> None:
        for name, held in list(self.tables.items()):
            if held is not None and any(held is f for f in frames):
                self.spark.sql(f"DROP TABLE {name}")
                self.tables[name] = None

    def only(self, df: DataFrame) -> DataFrame:
        """The rows as the one table that stays."""
        out = self.write(df)
        self.drop(*(f for f in self.tables.values() if f is not None and f is not out))
        return out


BITS, PAGE = 1 << 29, 1 << 15


def _bit(ids: Column) -> Column:
    return F.pmod(F.xxhash64(ids), F.lit(BITS))


def perhaps(rows: DataFrame, ids_col: str, ids: DataFrame) -> DataFrame:
    """(row, hit): the rows as structs, and whether their id may be among ids (one column); if not, it isn't for certain.

    A Bloom filter of fixed size: 64 MB of bits at most, in pages of 4 kB, however many ids there are. So what is joined by the ids
    themselves later is few rows as long as the ids are few, by the same plan at every size.
    """
    pages = ids.select(_bit(F.col(ids.columns[0])).alias("b")).groupBy(F.floor(F.col("b") / PAGE).alias("page")).agg(F.bitmap_construct_agg(F.pmod(F.col("b"), F.lit(PAGE))).alias("bits"))
    place = F.pmod(F.col("b"), F.lit(PAGE)).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hashed = rows.select(F.struct("*").alias("row"), _bit(F.col(ids_col)).alias("b")).withColumn("page", F.floor(F.col("b") / PAGE))
    return hashed.join(F.broadcast(pages), "page", "left").select("row", F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False)).alias("hit"))


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """The same rows as a written table."""
    return Scratch(df.sparkSession).write(df, codec)


@contextmanager
def collector_resting() -> Iterator[None]:
    """No search for cycles of objects meanwhile: for code that makes many objects and no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def give_back() -> None:
    """Returns the freed memory of a worker process, which goes on to other stages, to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of each range, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Pieces:
    """Texts cut at each space: the distinct pieces, the number of each piece in its text's order, and where each text begins."""

    def __init__(self, texts: list[str]):
        cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        coded = cut.values.dictionary_encode()
        self.distinct, self.codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        self.offsets = cut.offsets.to_numpy()

    def joined(self, ids: list[bytes], skip_first: bool = False) -> list[np.ndarray]:
        """For each text the ids of its pieces, side by side; those of distinct piece k are ids[k], as 32-bit integers."""
        size = np.array([len(x) for x in ids], np.int64) >> 2
        every = np.frombuffer(b"".join(ids), "<u4")
        own = size[self.codes]
        if skip_first:
            own[self.offsets[:-1]] = 0
        out = every[spread((np.cumsum(size) - size)[self.codes], own)]
        ends = np.concatenate([[0], np.cumsum(own)])[self.offsets].tolist()
        return [out[a:z] for a, z in zip(ends, ends[1:], strict=False)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte after its last."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~WHITE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal bytes give equal hashes wherever they stand."""
    p, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str, lower: bool = True) -> np.ndarray:
    """A hash for each word of the text, in order; A-Z count as a-z with lower."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if lower:
        data = LOWER[data]
    return span_hashes(data, *word_bounds(data))


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words; empty where there are fewer."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    p, _ = powers(n)
    out = words[: len(words) - n + 1] * p[0]
    for k in range(1, n):
        out = out + words[k : len(words) - n + 1 + k] * p[k]
    return mixed(out + np.uint64(n))


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct n-word shingles; with fewer words the whole sequence is the one shingle, without words there is none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(windows(words, min(n, len(words))))


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]
