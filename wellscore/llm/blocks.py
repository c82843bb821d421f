"""Blocks: documents written once in pieces of bounded size, and tables answered per block.

A block is a run of rows that one task wrote together, at most `limit` text bytes (or one
longer text). Work that needs the corpus for every string of a block is done in two steps:
a task asks once for each distinct 64-bit key of its block (sorted binary blobs, dealt by key
range), the ranges are counted, and the answers are written in a folder per block, from where
the tasks that read the block's texts load them. So the texts are never shuffled, repeated
keys are merged before the shuffle, no key is hot (it occurs once per block), and a task
holds one block and its answers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellscore.llm.common import binary, fresh, table_rows, text_bytes


def write_blocks(documents: DataFrame, limit: int = 1 << 24) -> DataFrame:
    """(block, n_rows, doc_id, text): the documents in the shared folder; rows of a block are neighbours.

    A file is one row group, so a task reads whole files and with them whole blocks."""
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        from pyspark import TaskContext

        block, held, parts = TaskContext.get().partitionId() << 24, 0, []

        def out():
            rows = sum(p.num_rows for p in parts)
            for p in parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(p.num_rows, block)), pa.array(np.full(p.num_rows, rows)), p.column(0), p.column(1)], ["block", "n_rows", "doc_id", "text"])

        for b in batches:
            _, offs = text_bytes(b.column(1))
            lo = 0
            for i, n in enumerate(np.diff(offs).tolist()):
                if held and held + n > limit:
                    parts.append(b.slice(lo, i - lo))
                    yield from out()
                    block, held, parts, lo = block + 1, 0, [], i
                held += n
            parts.append(b.slice(lo))
        yield from out()

    fields = f"block long, n_rows long, doc_id {kind}, text string"
    path = fresh(spark, "blocks")
    table_rows(documents, doc_id="doc_id", text="text").mapInArrow(cut, fields).write.options(**{"compression": "zstd", "parquet.block.size": 1 << 30}).parquet(path)
    return spark.read.schema(fields).parquet(path)


def by_block(batches):
    """(block, table of doc_id and text) with all rows of a block together."""
    block, held, left = None, [], 0
    for b in batches:
        lo = 0
        while lo < b.num_rows:
            if not left:
                block, left, held = b.column(0)[lo].as_py(), b.column(1)[lo].as_py(), []
            take = min(left, b.num_rows - lo)
            if b.column(0)[lo + take - 1].as_py() != block:
                raise ValueError("a block was read in parts")
            held.append(b.slice(lo, take).select([2, 3]))
            lo, left = lo + take, left - take
            if not left:
                yield int(block), pa.Table.from_batches(held)
    if left:
        raise ValueError("a block was read in parts")


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def ask(texts: DataFrame, per_block, answer, dtypes: list[str], n_keys: int, name: str) -> tuple[str, list[int]]:
    """Ask for the keys of all blocks; the folder of the answers, and sums over all ranges.

    per_block(block, table) gives sorted distinct keys (uint64) and columns of the same length
    (dtypes). answer(keys, columns) gets those of all blocks for one range of keys, block after
    block, and gives one number per row and a list of numbers to be summed."""
    spark = texts.sparkSession
    # some hundred thousand keys a range for even tasks; more, up to 64 MB of keys, where blocks are many
    each = min(1 << 23, max(1 << 18, n_keys >> 12))
    bits = max(4, math.ceil(math.log2(max(1, n_keys / each))))

    def requests(batches):
        for block, t in by_block(batches):
            keys, cols = per_block(block, t)
            at = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(at))
            blobs = [binary([x[at[r] : at[r + 1]].tobytes() for r in full]) for x in (keys, *cols)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(full), block), pa.int64()), pa.array(full, pa.int32()), *blobs], ["block", "range", "keys", *[f"c{i}" for i in range(len(cols))]])

    def reply(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("keys")]
        cols = [np.concatenate([np.frombuffer(x.as_py(), d) for x in t.column(f"c{i}")]) for i, d in enumerate(dtypes)]
        got, sums = answer(np.concatenate(parts), cols)
        got = got.astype(np.uint32 if not len(got) or got.max() < 1 << 32 else np.uint64)
        ends = np.cumsum([len(x) for x in parts])
        blobs = binary([got[e - len(x) : e].tobytes() for x, e in zip(parts, ends, strict=True)])
        none = pa.array([sums] + [None] * (len(parts) - 1), pa.list_(pa.int64()))
        return pa.table({"block": t.column("block"), "range": t.column("range"), "width": pa.array([got.itemsize] * len(parts), pa.int32()), "got": blobs, "sums": none})

    fields = "block long, range int, keys binary" + "".join(f", c{i} binary" for i in range(len(dtypes)))
    out = texts.mapInArrow(requests, fields).groupBy("range").applyInArrow(reply, "block long, range int, width int, got binary, sums array<long>")
    folder = fresh(spark, name)
    out.repartition("block").sortWithinPartitions("block", "range").write.partitionBy("block").option("compression", "zstd").parquet(folder)
    sums = spark.read.schema("sums array<long>").parquet(folder).filter("sums IS NOT NULL").select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
    return folder, [r["s"] for r in sums]


def answers(folder: str, block: int) -> np.ndarray:
    """The answers to a block's keys, in their order."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(_uri(folder))
    files = store.get_file_info(fs.FileSelector(f"{base}/block={block}", allow_not_found=True))
    rows = [r for f in files if f.base_name.startswith("part-") for r in pq.ParquetFile(store.open_input_file(f.path)).read(["range", "width", "got"]).to_pylist()]
    got = [np.frombuffer(r["got"], np.uint32 if r["width"] == 4 else np.uint64) for r in sorted(rows, key=lambda r: r["range"])]
    return np.concatenate(got) if got else np.zeros(0, np.uint32)


def text_size(documents: DataFrame) -> int:
    """Bytes of all texts."""
    return documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
