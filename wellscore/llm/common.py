"""Helpers shared by the llm operators: shared-folder tables, word hashing in
numpy over Arrow buffers, and connected components over link tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one is made only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Inside, an Arrow batch that a Python worker gets holds about BATCH_BYTES bytes, however long its rows are (one row at least).

    Otherwise it has 10,000 rows, which a task holds as Arrow buffers outside the heap and its worker holds again."""
    before = spark.conf.get(BATCH_LIMIT, None)
    spark.conf.set(BATCH_LIMIT, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_LIMIT)
        else:
            spark.conf.set(BATCH_LIMIT, before)


def written(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write df under the shared folder and read it back: lineage ends here and its size is known. small: with small_batches."""
    spark = df.sparkSession
    path = fresh(spark, name)
    with small_batches(spark) if small else nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_rows(df: DataFrame, **names: str) -> DataFrame:
    """Only the columns an operator needs, under its own names: other columns can't clash."""
    return df.select(*[F.col(f"`{have}`").alias(want) for want, have in names.items()])


# ---- text as bytes -------------------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
#: A random odd 64-bit number for each byte value, and the base of the polynomial.
BYTE_ID = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_ID_LOWER = BYTE_ID.copy()
BYTE_ID_LOWER[65:91] = BYTE_ID[97:123]
BASE = 0x9E3779B97F4A7C15 | 1
_POW: dict[str, np.ndarray] = {}

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (grown on demand, kept by the worker)."""
    have = _POW.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POW[name] = np.cumprod(p)
    return _POW["up"][:n], _POW["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_ids(buf: np.ndarray, ids: np.ndarray = BYTE_ID) -> np.ndarray:
    """Sums of byte id times BASE**position: [n + 1]."""
    up, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(ids[buf] * up[:-1], out=out[1:])
    return out


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def slices(offs: np.ndarray, limit: int = 1 << 19):
    """Row ranges of about limit bytes each; a longer text is a range of its own."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (run of non-white-space bytes within a row)."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~IS_SPACE[buf]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    heads = offs[:-1][offs[:-1] < offs[1:]]
    first[heads] = solid[heads]
    tails = offs[1:][offs[:-1] < offs[1:]] - 1
    last[tails] = solid[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, ids: np.ndarray = BYTE_ID) -> np.ndarray:
    p = prefix_ids(buf, ids)
    _, down = powers(len(buf) + 1)
    return mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64))


def window_hashes(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of one row, and the index of the first word of each."""
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - k + 1
    out = h[:m].copy()
    for j in range(1, k):
        out = mix(out * np.uint64(BASE) + h[j : j + m])
    at = np.flatnonzero(row[:m] == row[k - 1 :])
    return out[at], at


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


# ---- connected components ------------------------------------------------------------------


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, class): the least id of each connected component of links (a, b).

    Alternates large-star and small-star steps. Each step groups by node with map-side
    partial minima only, so a hub with any number of neighbours is never collected; every
    round is cut by a table in the shared folder. Ids without a link aren't returned.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.filter("m < u").select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("u").agg(F.min("v").alias("class")).unionByName(edges.select("v", F.col("v").alias("c")).distinct().toDF("u", "class")).withColumnRenamed("u", "id")
