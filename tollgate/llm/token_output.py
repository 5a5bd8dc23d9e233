"""Token ids of whole documents in a bit-plane shuffled binary format.

Documents are range-partitioned and sorted by id.  Each partition encodes its
texts and streams the ids to one shard file; a manifest row per shard names the
files that count.  Readers take shards one by one and never need a whole shard
in memory.

Shard file::

    b"IDPLANE1"
    id chunks        up to CHUNK_IDS ids: the 32-bit ids transposed into byte
                     planes (4) or bit planes (32), each plane one zstd frame
    document chunks  up to CHUNK_DOCS documents: doc ids (int64), null flags
                     and lengths, each one zstd frame, between the id chunks
    index            zstd JSON: planes, and per chunk its kind, offset, number
                     of entries and frame lengths
    index length (uint64), b"IDPLANE1"

A shard is written under a name of its attempt and then renamed, so a task
that runs twice leaves one whole file of the same content.

Encoding cuts a text where the byte-level tokenizer always cuts too (before
white space that follows a non-space, and between ASCII letters, digits and
punctuation other than the apostrophe), encodes each distinct piece once with
the tokenizers library and puts the ids together.  Texts with non-ASCII white
space or a special token's string are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.staging import materialise, shared_path
from tollgate.llm.textarrays import Block, blocks, mix

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
CHUNK_IDS, CHUNK_DOCS = 1 << 16, 1 << 14
MAGIC = b"IDPLANE1"

# ------------------------------------------------------------- encoding ---

_CLASS = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 punctuation; 0 is never cut between
_CLASS[0x21:0x7F] = 3
_CLASS[0x30:0x3A] = 2
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1
_CLASS[0x27] = 0
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CONTROL = np.zeros(256, bool)
_CONTROL[[*range(0x20), 0x7F]] = True


class PieceEncoder:
    """Ids of texts by distinct pieces; remembers pieces up to a bound."""

    SLOTS, ARENA = 1 << 21, 1 << 23

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        marks = [re.escape(str(t.content).encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        wide = b"|".join(re.escape(c.encode()) for c in _wide_spaces())
        self.whole = re.compile(b"|".join([*marks, wide]))
        self._reset()

    def _reset(self) -> None:
        # A slot's piece: its bytes as two numbers, and its length.
        self.low = np.zeros(self.SLOTS, np.uint64)
        self.high = np.zeros(self.SLOTS, np.uint64)
        self.length = np.zeros(self.SLOTS, np.int8)
        self.at = np.zeros(self.SLOTS, np.int32)
        self.size = np.zeros(self.SLOTS, np.int32)
        self.long: dict[bytes, tuple[int, int]] = {}
        self.long_bytes = 0
        self.arena = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _remember(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((x for ids in lists for x in ids), np.uint32, int(size.sum()))
        at = self.used + np.concatenate([[0], np.cumsum(size)[:-1]])
        if self.used + len(flat) > len(self.arena):
            self.arena = np.concatenate([self.arena[:self.used], np.zeros(2 * (self.used + len(flat)), np.uint32)])
        self.arena[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        return at, size

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block's texts, each with its end id, and the lengths."""
        if self.used > self.ARENA or self.long_bytes > self.ARENA:
            self._reset()
        data, bounds, n = block.data, block.bounds, block.n
        cut = np.zeros(len(data) + 1, bool)
        kind = _CLASS[data]
        space = _SPACE[data]
        if len(data):
            cut[1:-1] = (space[1:] & ~space[:-1] & ~_CONTROL[data[:-1]]) | (
                (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0))
        whole = {int(np.searchsorted(bounds, m.start(), side="right")) - 1 for m in self.whole.finditer(data)}
        for i in whole:
            cut[bounds[i]:bounds[i + 1]] = False
        cut[bounds] = True
        start = np.flatnonzero(cut[:-1])
        end = np.append(start[1:], len(data))[:len(start)]
        at, size = self._places(data, start, end)
        text = np.searchsorted(bounds, start, side="right") - 1
        total = int(size.sum())
        begin = np.cumsum(size) - size
        out = np.full(total + n, END_ID, np.uint32)
        position = np.arange(total)
        out[position + np.repeat(text, size)] = self.arena[np.repeat(at - begin, size) + position]
        return out, np.bincount(text, weights=size, minlength=n).astype(np.int64) + 1

    def _places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of each piece's ids in the arena.  Pieces are told
        apart by all of their bytes."""
        length = end - start
        low, high = _sixteen(data, start, length)
        slot = (mix(low ^ mix(high + length.astype(np.uint64))) >> np.uint64(43)).astype(np.int64)
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        short = length <= 16
        missing = np.flatnonzero(short & ((size == 0) | (self.low[slot] != low) | (self.high[slot] != high)
                                          | (self.length[slot] != length)))
        raw = data.tobytes()

        def text(i: int) -> str:
            return raw[start[i]:end[i]].decode()

        if len(missing):
            order = missing[np.lexsort((length[missing], high[missing], low[missing]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]]) | (
                length[order[1:]] != length[order[:-1]])
            new, back = order[fresh], np.cumsum(fresh) - 1
            new_at, new_size = self._remember(self._ids([text(i) for i in new.tolist()]))
            at[order], size[order] = new_at[back], new_size[back]
            to = slot[new]
            self.low[to], self.high[to], self.length[to] = low[new], high[new], length[new]
            self.at[to], self.size[to] = new_at, new_size
        longer = np.flatnonzero(~short).tolist()
        if longer:
            pieces = [raw[start[i]:end[i]] for i in longer]
            unknown = [x for x in dict.fromkeys(pieces) if x not in self.long]
            if unknown:
                new_at, new_size = self._remember(self._ids([x.decode() for x in unknown]))
                self.long.update(zip(unknown, zip(new_at.tolist(), new_size.tolist(), strict=True), strict=True))
                self.long_bytes += sum(map(len, unknown))
            at[longer], size[longer] = (list(x) for x in zip(*(self.long[x] for x in pieces), strict=True))
        return at, size


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder_of(path: str) -> PieceEncoder:
    """The worker's encoder: the pieces it knows serve all tasks that the
    worker gets, within the encoder's own bounds."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _sixteen(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes of each span as two numbers, zero beyond its end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    low = eight[start] & _MASKS[np.minimum(length, 8)]
    return low, eight[start + np.minimum(length, 8)] & _MASKS[np.clip(length - 8, 0, 8)]


_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def _wide_spaces() -> list[str]:
    """White space that the cuts do not know."""
    return [c for c in map(chr, range(0x1C, 0x3001)) if c.isspace() and c != " "]


# --------------------------------------------------------------- format ---

def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    columns = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        columns = np.unpackbits(columns, axis=1, bitorder="little")
        return [np.packbits(columns[:, i], bitorder="little").tobytes() for i in range(32)]
    return [columns[:, i].tobytes() for i in range(4)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if bits:
        columns = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n] for p in planes], axis=1)
        columns = np.packbits(columns, axis=1, bitorder="little")
    else:
        columns = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    return np.ascontiguousarray(columns).view("<u4").reshape(-1)


class ShardWriter:
    """Streams documents to one shard file."""

    def __init__(self, stream, bits: bool = False, level: int = 3):
        self.stream, self.bits = stream, bits
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.ids, self.n_waiting = [], 0
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.index: list[list] = []
        self.offset = len(MAGIC)
        self.n_ids = self.n_docs = self.docs_waiting = 0
        stream.write(MAGIC)

    def _chunk(self, kind: str, n: int, frames: list[bytes]) -> None:
        frames = [self.zstd.compress(f) for f in frames]
        self.index.append([kind, self.offset, n, [len(f) for f in frames]])
        for f in frames:
            self.stream.write(f)
            self.offset += len(f)

    def append(self, doc_ids: np.ndarray, nulls: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids.append(ids)
        self.n_waiting += len(ids)
        self.docs.append((doc_ids, nulls, lengths))
        self.docs_waiting += len(lengths)
        self.n_ids += len(ids)
        self.n_docs += len(lengths)
        self._flush(CHUNK_IDS, CHUNK_DOCS)

    def _flush(self, least_ids: int, least_docs: int) -> None:
        if self.n_waiting >= max(least_ids, 1):
            ids, at = np.concatenate(self.ids), 0
            while len(ids) - at >= max(least_ids, 1):
                part = ids[at:at + CHUNK_IDS]
                self._chunk("ids", len(part), to_planes(part, self.bits))
                at += len(part)
            self.ids, self.n_waiting = [ids[at:]], len(ids) - at
        if self.docs_waiting >= max(least_docs, 1):
            doc_ids, nulls, lengths = (np.concatenate(x) for x in zip(*self.docs, strict=True))
            for at in range(0, len(lengths), CHUNK_DOCS):
                to = slice(at, at + CHUNK_DOCS)
                self._chunk("docs", len(lengths[to]), [doc_ids[to].astype("<i8").tobytes(), nulls[to].astype("u1").tobytes(),
                                                       lengths[to].astype("<i8").tobytes()])
            self.docs, self.docs_waiting = [], 0

    def close(self) -> None:
        self._flush(0, 0)
        index = self.zstd.compress(json.dumps({"bits": self.bits, "chunks": self.index}).encode())
        self.stream.write(index + len(index).to_bytes(8, "little") + MAGIC)


class ShardReader:
    """Reads a shard file chunk by chunk through its index."""

    def __init__(self, handle):
        self.handle, self.zstd = handle, zstandard.ZstdDecompressor()
        size = handle.size()
        tail = self._read(size - 16, 16)
        if tail[8:] != MAGIC or self._read(0, 8) != MAGIC:
            raise ValueError("not a shard file, or cut short")
        length = int.from_bytes(tail[:8], "little")
        index = json.loads(self.zstd.decompress(self._read(size - 16 - length, length)))
        self.bits = index["bits"]
        self.chunks = {k: [c[1:] for c in index["chunks"] if c[0] == k] for k in ("ids", "docs")}

    def _read(self, at: int, n: int) -> bytes:
        return self.handle.read_at(n, at)

    def _frames(self, chunk: list) -> list[bytes]:
        offset, _, lengths = chunk
        raw, at, out = self._read(offset, sum(lengths)), 0, []
        for n in lengths:
            out.append(self.zstd.decompress(raw[at:at + n]))
            at += n
        return out

    def ids(self) -> Iterator[np.ndarray]:
        for chunk in self.chunks["ids"]:
            yield from_planes(self._frames(chunk), chunk[1], self.bits)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc id, its ids with the end id) in file order."""
        source, have = self.ids(), np.zeros(0, np.uint32)
        for chunk in self.chunks["docs"]:
            doc_ids, nulls, lengths = (np.frombuffer(f, t) for f, t in zip(
                self._frames(chunk), ("<i8", "u1", "<i8"), strict=True))
            for doc, null, n in zip(doc_ids.tolist(), nulls.tolist(), lengths.tolist(), strict=True):
                parts = [have]
                while (missing := n - sum(map(len, parts))) > 0:
                    parts.append(next(source))
                joined = np.concatenate(parts) if len(parts) > 1 else have
                have = joined[n:]
                yield (None if null else doc), joined[:n]


# ------------------------------------------------------------------ jobs ---

def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def _write_shards(out_uri: str, tokenizer: str, bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        fs, folder = _filesystem(out_uri)
        final = f"{folder}/shard-{shard:06d}.ids"
        attempt = f"{final}.{uuid.uuid4().hex}"
        encoder = writer = None
        try:
            for batch in batches:
                if writer is None and batch.num_rows:
                    fs.create_dir(folder, recursive=True)
                    encoder = encoder_of(tokenizer)
                    stream = fs.open_output_stream(attempt)
                    writer = ShardWriter(stream, bits)
                doc = batch.column("doc_id")
                nulls = doc.is_null().to_numpy(zero_copy_only=False)
                values = doc.fill_null(0).to_numpy()
                for block in blocks(batch.column("body")):
                    ids, lengths = encoder.encode(block)
                    to = slice(block.first, block.first + block.n)
                    writer.append(values[to], nulls[to], ids, lengths)
            if writer is None:
                return
            writer.close()
            stream.close()
            fs.move(attempt, final)
            writer_done = writer
        except BaseException:
            if writer is not None:
                stream.close()
                fs.delete_file(attempt)
            raise
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int64()), "file": [f"shard-{shard:06d}.ids"],
            "n_docs": pa.array([writer_done.n_docs], pa.int64()), "n_ids": pa.array([writer_done.n_ids], pa.int64())})

    return run


def write_token_ids(docs: DataFrame, out_uri: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                    shards: int | None = None, bits: bool = False) -> DataFrame:
    """Write shard files in ascending id order; returns the manifest
    (shard, file, n_docs, n_ids).  ``out_uri`` must be reachable by every
    executor.  ``tokenizer`` is the path of a byte-level tokenizer file."""
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    tie = F.xxhash64("body")  # repeated ids still spread, in a defined order
    dealt = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), tie)
    return materialise(dealt.mapInArrow(_write_shards(out_uri, tokenizer, bits),
                                        "shard long, file string, n_docs long, n_ids long"), "manifest")


def _read_shards(out_uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _filesystem(out_uri)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                start, rows = base, []
                with fs.open_input_file(f"{folder}/{name}") as handle:
                    for doc, ids in ShardReader(handle).documents():
                        rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _digest(rows)
                            rows = []
                if rows:
                    yield _digest(rows)

    return run


def _digest(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(manifest: DataFrame, out_uri: str) -> DataFrame:
    """One row per document read back from the files: doc_id, start, n_tokens, ids_crc32."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    based = manifest.select("shard", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")).alias("base"))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return based.repartitionByRange(n, "shard").mapInArrow(
        _read_shards(out_uri), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str | None = None, out_uri: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", bits: bool = False) -> DataFrame:
    """Write ``docs`` as token-id shards, read them back and return one row per
    document: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts have the end id only.  Null ids come first; repeated
    ids follow each other by a hash of their text.  An empty table writes no
    file and gives an empty result.  Other columns are not read.
    """
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    out_uri = out_uri or shared_path(docs.sparkSession, "token-ids")
    return read_digests(write_token_ids(docs, out_uri, tokenizer, id_col, text_col, bits=bits), out_uri)
