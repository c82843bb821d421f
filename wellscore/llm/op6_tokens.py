"""Token ids in seekable zstandard files.

A file holds the ids of documents in ascending (doc_id, text) order as little-endian unsigned
integers of 2 or 4 bytes. It is cut into independent zstandard frames of about `frame_bytes`
bytes; a skippable frame at the end is the seek table: compressed size, size and 32-bit xxhash
of every frame (the public seekable format), so a reader decompresses and checks only the
frames of the documents asked for. The index table (doc_id, part, local start, n_tokens) is
written beside the files, the first ids of the files follow from one row per file.

Texts are dealt by ranges of (doc_id, hash of the text, row number): repeated ids, null ids and
copies spread over files too. A file is written under a name of its own and renamed when it is
complete, so a retried or doubled task leaves the same file. Ids never pass the driver.

Each worker encodes a piece (see pieces) once: the tokenizer never merges across the cuts, so
the ids of a text are those of its pieces. Literals of the vocabulary's added tokens (end of text)
are ids of their own, as in the library's plain encode; with literal=True special ones are text.

Edge cases: a null or empty text is just the end id; null doc_ids come first; repeated rows
are documents of their own; an empty table has no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellscore.llm.common import BYTE_ID, fresh, mix, powers, prefix_ids, slices, small_batches, table_rows, text_bytes

MAGIC, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 1 << 18
#: Bytes of text encoded at a time: a worker holds some 50 bytes for each.
SLICE_BYTES = 1 << 20


# ---- files ---------------------------------------------------------------------------------


class Writer:
    """Writes bytes as independent frames and, at the end, the seek table."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.out, self.size, self.buf, self.table = out, frame_bytes, bytearray(), []
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)

    def write(self, data: bytes) -> None:
        self.buf += data
        while len(self.buf) >= self.size:
            self._frame(bytes(self.buf[: self.size]))
            del self.buf[: self.size]

    def _frame(self, raw: bytes) -> None:
        import xxhash

        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.table.append(struct.pack("<III", len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.buf:
            self._frame(bytes(self.buf))
        body = b"".join(self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", MAGIC, len(body)) + body)
        self.out.close()


class Reader:
    """Reads byte ranges of a file, decompressing only the frames that hold them; the last frame is kept."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.zstd, self.last = file, zstandard.ZstdDecompressor(), (-1, b"")
        file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError("no seek table with checksums")
        file.seek(size - 9 - 12 * n)
        t = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3)
        self.sums = t[:, 2]
        self.packed = np.concatenate([[0], np.cumsum(t[:, 0], dtype=np.int64)])
        self.raw = np.concatenate([[0], np.cumsum(t[:, 1], dtype=np.int64)])

    def _frame(self, k: int) -> bytes:
        import xxhash

        if self.last[0] != k:
            self.file.seek(int(self.packed[k]))
            raw = self.zstd.decompress(self.file.read(int(self.packed[k + 1] - self.packed[k])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k}: wrong checksum")
            self.last = (k, raw)
        return self.last[1]

    def read(self, start: int, end: int) -> bytes:
        out = []
        while start < end:
            k = int(np.searchsorted(self.raw, start, "right")) - 1
            at = start - int(self.raw[k])
            out.append(self._frame(k)[at : at + end - start])
            start += len(out[-1])
        return b"".join(out)


# ---- encoding ------------------------------------------------------------------------------


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LETTER = _ALNUM.copy()
_LETTER[48:58] = False
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_VISIBLE = _ALNUM | _MARK
_LEAD = np.zeros(256, bool)  # first byte of a Latin letter (or of the two signs between them)
_LEAD[0xC3:0xCA] = True


def pieces(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of pieces: texts, cut where the tokenizer never joins two tokens' bytes.

    That is before a single space and around a single line feed that stand between two visible
    ASCII or Latin characters, and between an ASCII letter and an ASCII mark."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    plain, lead = _VISIBLE[buf], _LEAD[buf]
    begins = plain | lead
    ends = plain.copy()
    ends[1:] |= (buf[1:] >= 0x80) & (buf[1:] < 0xC0) & lead[:-1]
    edge = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < n)]
    inner = np.ones(n, bool)  # neither first nor last byte of a row
    inner[edge] = inner[edge - 1] = False
    cut = np.zeros(n + 1, bool)
    lone = np.zeros(n, bool)
    lone[1:-1] = ends[:-2] & begins[2:] & inner[1:-1]
    cut[:-1] |= lone & ((buf == 32) | (buf == 10))
    cut[1:] |= lone & (buf == 10)
    cut[1:-1] |= _LETTER[buf[:-1]] & _MARK[buf[1:]]
    cut[edge] = True  # a row begins
    heads = np.flatnonzero(cut[:-1])
    heads = heads[heads > 0]
    return np.concatenate([[0], heads]), np.concatenate([heads, [n]])


class Encoder:
    """Encodes batches of texts; distinct pieces go through the tokenizer once."""

    def __init__(self, path: str, literal: bool = True):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = literal
        added = [t for t in self.tok.get_added_tokens_decoder().values() if t.content and not (literal and t.special)]
        self.added = np.array([self.tok.token_to_id(t.content) for t in added], np.int64)
        # the longest of those that begin first is taken; with options, a token can reach into its neighbours
        names = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.names = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.whole = any(t.lstrip or t.rstrip or t.single_word for t in added) or len({t.normalized for t in added}) > 1
        # bytes of a token, for byte-level vocabularies: a character of a token's name stands for one byte
        self.width = np.array([len(self.tok.id_to_token(i) or "") for i in range(self.tok.get_vocab_size())], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes of known pieces
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _added(self, buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int]]:
        """Start and end of the added tokens' literals; of whole rows that hold some, if tokens have options."""
        raw = buf.tobytes() if self.names else b""
        if not self.names or not self.names.search(raw):
            return []
        found = [(i, j, m.span()) for i, j in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True) for m in self.names.finditer(raw, i, j)]
        return sorted({(i, j) for i, j, _ in found}) if self.whole else [at for _, _, at in found]

    def _learn(self, h: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray, apart: np.ndarray) -> None:
        """Add pieces (h ascending). Many are encoded at a time where pieces() would cut them apart again:
        those with a space before them in a row, others as lines. A block whose tokens don't begin where
        its pieces do, and all other pieces (apart: those of added tokens), are encoded piece by piece."""
        size = end - start
        head, last = buf[start], buf[end - 1]
        begins = _VISIBLE | _LEAD
        ends = _VISIBLE[last] | ((size > 1) & (last >= 0x80) & (last < 0xC0) & _LEAD[buf[np.maximum(end - 2, 0)]])
        spaced = ends & (head == 32) & (size > 1) & begins[buf[np.minimum(start + 1, len(buf) - 1)]]
        alone = np.ones(len(h), bool)
        first, count = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        got, base = [self.ids], len(self.ids)
        for own, gap in ((np.flatnonzero(spaced & ~apart), 0), (np.flatnonzero(ends & begins[head] & ~apart), 1)):
            for lo in range(0, len(own), 8192):
                part = own[lo : lo + 8192]
                n = size[part]
                at = np.cumsum(n + gap) - n - gap
                inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                raw = np.full(int(at[-1] + n[-1]), 10, np.uint8)
                raw[np.repeat(at, n) + inside] = buf[np.repeat(start[part], n) + inside]
                ids = np.array(self.tok.encode_batch_fast([raw.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
                past = np.cumsum(self.width[ids])
                begin = past - self.width[ids]
                a, b = np.searchsorted(begin, at), np.searchsorted(begin, at + n)
                if past[-1] != len(raw) or (begin[a] != at).any() or (past[b - 1] != at + n).any() or np.isin(ids, self.added).any():
                    continue
                first[part], count[part], alone[part] = base + a, b - a, False
                got.append(ids)
                base += len(ids)
        rest = np.flatnonzero(alone)
        if len(rest):
            texts = [buf[i:j].tobytes().decode() for i, j in zip(start[rest].tolist(), end[rest].tolist(), strict=True)]
            ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            count[rest] = [len(x) for x in ids]
            first[rest] = base + np.cumsum(count[rest]) - count[rest]
            got.append(np.fromiter((y for x in ids for y in x), np.uint32, int(count[rest].sum())))
        self.ids = np.concatenate(got)
        k = np.searchsorted(self.known, h)
        self.known, self.first, self.count = np.insert(self.known, k, h), np.insert(self.first, k, first), np.insert(self.count, k, count)

    def encode(self, buf: np.ndarray, offs: np.ndarray, most: int = 8_000_000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the number of each row's ids."""
        if len(self.ids) > most:  # bounds the worker's memory
            self._forget()
        start, end = pieces(buf, offs)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        apart = np.zeros(len(start), bool)
        if spans := self._added(buf, offs):
            lo, hi = np.array(spans, np.int64).T
            inside = start[np.searchsorted(lo, start, "right") > np.searchsorted(hi, start, "right")]
            start = np.union1d(np.setdiff1d(start, inside), np.concatenate([lo, hi[hi < len(buf)]]))
            end = np.concatenate([start[1:], [len(buf)]])
            apart = np.isin(start, lo)
        p = prefix_ids(buf, BYTE_ID)
        _, down = powers(len(buf) + 1)
        h = mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64))
        u, at, inv = np.unique(h, return_index=True, return_inverse=True)
        k = np.minimum(np.searchsorted(self.known, u), max(0, len(self.known) - 1))
        new = self.known[k] != u if len(self.known) else np.ones(len(u), bool)
        if new.any():
            self._learn(u[new], buf, start[at[new]], end[at[new]], apart[at[new]])
        k = np.searchsorted(self.known, u)[inv]
        n = self.count[k]
        total = np.cumsum(n)
        out = self.ids[np.repeat(self.first[k] - (total - n), n) + np.arange(int(total[-1]))]
        row = np.searchsorted(offs, start, "right") - 1
        return out, np.bincount(row, n, len(offs) - 1).astype(np.int64)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, literal: bool = True) -> Encoder:
    """The worker's encoder: what one task learned serves the next tasks of the same worker."""
    if (path, literal) not in _ENCODERS:
        _ENCODERS[path, literal] = Encoder(path, literal)
    return _ENCODERS[path, literal]


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# ---- operator ------------------------------------------------------------------------------


def write(documents: DataFrame, tokenizer: str, end_id: int = 0, width: int = 2, frame_bytes: int = FRAME_BYTES, literal: bool = True, stored_order: bool = False) -> tuple[str, DataFrame]:
    """Write files and index; (folder, index). stored_order: documents follow each other as they lie in the table, one file per
    partition that is read, with no shuffle; otherwise by ascending doc_id. width: bytes of an id, 2 if all ids are below 65,536, else 4.
    literal: special tokens in a text are plain text."""
    spark = documents.sparkSession
    folder = fresh(spark, "tokens")
    root = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    d = table_rows(documents, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    if not stored_order:
        d = d.withColumns({"h": F.xxhash64("text"), "i": F.monotonically_increasing_id()})
        d = d.repartitionByRange("doc_id", "h", "i").sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    dtype = {2: "<u2", 4: "<u4"}[width]

    def put(batches):
        import uuid

        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, base = _filesystem(root)
        fs.create_dir(f"{base}/data", recursive=True)
        temp = f"{base}/data/_{part:06d}-{uuid.uuid4().hex}"
        enc, out, at, seq = encoder(tokenizer, literal), None, 0, 0
        for b in batches:
            buf, offs = text_bytes(b.column(1))
            if out is None and len(offs) > 1:
                out = Writer(fs.open_output_stream(temp), frame_bytes)
            counts = []
            for lo, hi in slices(offs, SLICE_BYTES):
                ids, n = enc.encode(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                if len(ids) and int(ids.max()) >= 1 << (8 * width):
                    raise ValueError("an id needs more bytes")
                ends = np.cumsum(n)
                full = np.insert(ids, ends, end_id)  # the end id follows each document's ids
                out.write(full.astype(dtype).tobytes())
                counts.append(n + 1)
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            start = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(n), part), pa.int32()), pa.array(np.arange(seq, seq + len(n)), pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "part", "seq", "at", "n_tokens"])
            seq += len(n)
        if out is not None:
            out.close()
            fs.move(temp, f"{base}/data/{part:06d}.zst")

    fields = f"doc_id {kind}, part int, seq long, at long, n_tokens long"
    with small_batches(spark):
        d.mapInArrow(put, fields).write.parquet(f"{folder}/index")
    return folder, spark.read.schema(fields).parquet(f"{folder}/index")


def read(folder: str, index: DataFrame, width: int = 2, ids: bool = False) -> DataFrame:
    """Documents of the index (all, or those wanted) from the files: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids."""
    root = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    totals = index.sparkSession.read.parquet(f"{folder}/index").groupBy("part").agg(F.sum("n_tokens").alias("t"))
    # one row per file
    before = totals.select(F.col("part").alias("p"), (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    kind = index.schema["doc_id"].dataType.simpleString()

    def get(batches):
        fs, base = _filesystem(root)
        part, reader = None, None
        for b in batches:
            sums, got = [], []
            for p, at, n in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if p != part:
                    path = f"{base}/data/{p:06d}.zst"
                    part, reader = p, Reader(fs.open_input_file(path), fs.get_file_info(path).size)
                raw = np.frombuffer(reader.read(width * at, width * (at + n)), {2: "<u2", 4: "<u4"}[width]).astype("<u4").tobytes()
                sums.append(zlib.crc32(raw))
                if ids:
                    got.append(np.frombuffer(raw, "<u4").astype(np.int64))
            cols = [b.column(0), b.column(1), b.column(3), b.column(4), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(got, pa.list_(pa.int64()))] if ids else []), names=["doc_id", "part", "at", "n_tokens", "ids_crc32"] + ["ids"] * ids)

    out = index.mapInArrow(get, f"doc_id {kind}, part int, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)
    return out.join(F.broadcast(before) if totals.count() <= 1_000_000 else before, F.col("part") == F.col("p")).select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)


def encoded(documents: DataFrame, tokenizer: str, literal: bool = True, stored_order: bool = False) -> DataFrame:
    """Write all documents and read them back: doc_id, start, n_tokens, ids_crc32."""
    return read(*write(documents, tokenizer, literal=literal, stored_order=stored_order))
