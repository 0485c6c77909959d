"""Operator 8, token ids in bit-plane shuffled binary shards.

Documents are range-partitioned and sorted by id; each task encodes its slice
and streams the ids of all its documents, each followed by ``end_id``, into
one shard.  A shard cuts the id stream into blocks of ``block_ids``; a block is
transposed into planes (all lowest bytes, all second bytes, ... or single
bits), and each plane is compressed with zstandard on its own.  Layout, all
numbers little-endian::

    b"BPIDS1" u8 bits per plane (8 or 1), u8 zero
    blocks:   the compressed planes, lowest first
    index:    per block u64 position, u32 ids, u32 compressed bytes per plane
    footer:   u64 index position, u32 blocks, b"BPIE"

The document index (doc_id, shard, shard_no, first, n_tokens) is an ordinary
Parquet table.  A shard's name is unique per attempt and only shards named in
that table count, so a task that runs again (lost executor, speculation)
leaves at most an unreferenced file.

Encoding: the tokenizer lower-cases and splits at white space before anything
else, and no token crosses white space, so a text's ids are those of its
space-separated chunks.  Chunks are encoded by the tokenizers library, in
batches, and remembered per worker (``CACHE_CHUNKS`` at most).  Added tokens are
found in the text as written, so a chunk that holds one in any case is passed
and remembered as written, all others in lower case.  This holds for
lower-casing tokenizers whose pre-tokens never span white space;
``chunked=False`` hands whole texts to the library for any other.

Defined results: a null text counts as empty (one id, the end id); null ids
come first; repeated ids are ordered by text; an empty table gives an empty
index and no shard; extra columns are ignored.  Memory: one block, one Arrow
batch and the chunk cache.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.llm.common import file_system, qualified_uri

HEAD, TAIL = b"BPIDS1", b"BPIE"
BLOCK_IDS = 1 << 18
CACHE_CHUNKS = 1_000_000
ID_BYTES = 4


# ---------------------------------------------------------------- encoding


class ChunkEncoder:
    """Texts to little-endian uint32 ids through the tokenizers library, remembering chunks."""

    def __init__(self, tokenizer_path: str, chunked: bool = True, cache_chunks: int = CACHE_CHUNKS) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.chunked = chunked
        self.limit = cache_chunks
        self.cache: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _library(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _learn(self, chunks: set[bytes]) -> None:
        """Encode unseen chunks.  Words of letters only are single pre-tokens, each ending in an end-of-word
        token, so many go to the library as one text and are cut apart after those tokens."""
        cache = self.cache
        words, others, marked = [], [], []
        for chunk in chunks:
            if chunk[-1:] in (b",", b".") and (base := chunk[:-1].decode()).isalpha() and base.lower().isalpha():
                marked.append(chunk)
                if chunk[:-1] not in cache and chunk[:-1] not in chunks:
                    words.append(base)
            elif (text := chunk.decode()).isalpha() and text.lower().isalpha():
                words.append(text)
            else:
                others.append(text)
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                raw, first = ids.tobytes(), 0
                for word, stop in zip(part, (stops * ID_BYTES).tolist(), strict=True):
                    cache[word.encode()] = raw[first:stop]
                    first = stop
            else:
                cache.update(zip((w.encode() for w in part), self._library(part), strict=True))
        cache.update(zip((t.encode() for t in others), self._library(others), strict=True))
        if marked:
            mark = {m: self._library([m.decode()])[0] for m in (b",", b".")}
            for chunk in marked:
                cache[chunk] = cache[chunk[:-1]] + mark[chunk[-1:]]

    def _chunks(self, text: str) -> list[bytes]:
        raw = text.encode("utf-8", "replace")
        low = raw.lower()  # ASCII capitals only: the tokenizer lower-cases the rest itself.
        if not any(token in low for token in self.added):
            return low.split()
        return [r if any(token in c for token in self.added) else c for r, c in zip(raw.split(), low.split(), strict=True)]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if not self.chunked:
            yield from self._library(texts)
            return
        for text in texts:
            chunks = self._chunks(text)
            found = list(map(self.cache.get, chunks))
            if None in found:
                if len(self.cache) >= self.limit:
                    self.cache.clear()
                self._learn(set(chunks).difference(self.cache))
                found = map(self.cache.__getitem__, chunks)
            yield b"".join(found)


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(tokenizer_path: str, chunked: bool) -> ChunkEncoder:
    """One encoder per Python worker, kept between tasks."""
    key = (tokenizer_path, chunked)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(tokenizer_path, chunked)
    return _ENCODERS[key]


# ---------------------------------------------------------------- planes and shards


def to_planes(ids: bytes, bits: int) -> list[bytes]:
    """Byte planes (bits=8) or bit planes (bits=1) of little-endian uint32 ids, lowest first."""
    octets = np.frombuffer(ids, np.uint8).reshape(-1, ID_BYTES)
    if bits == 8:
        return [octets[:, k].tobytes() for k in range(ID_BYTES)]
    flags = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(flags[:, k], bitorder="little").tobytes() for k in range(8 * ID_BYTES)]


def from_planes(planes: list[bytes], n: int, bits: int) -> bytes:
    if bits == 8:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).tobytes()
    flags = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.packbits(flags, axis=1, bitorder="little").tobytes()


class ShardWriter:
    def __init__(self, stream, block_ids: int, bits: int, level: int) -> None:
        import zstandard

        self.stream, self.bits = stream, bits
        self.block_bytes = block_ids * ID_BYTES
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.pending, self.pending_bytes, self.written = [], 0, 0
        self.index: list[bytes] = []
        self._put(HEAD + bytes([bits, 0]))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.written += len(data)

    def _block(self, ids: bytes) -> None:
        planes = [self.compress(p) for p in to_planes(ids, self.bits)]
        self.index.append(struct.pack(f"<QI{len(planes)}I", self.written, len(ids) // ID_BYTES, *map(len, planes)))
        for plane in planes:
            self._put(plane)

    def add(self, ids: bytes) -> None:
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        if self.pending_bytes >= self.block_bytes:
            data = b"".join(self.pending)
            whole = len(data) // self.block_bytes * self.block_bytes
            for at in range(0, whole, self.block_bytes):
                self._block(data[at : at + self.block_bytes])
            self.pending, self.pending_bytes = [data[whole:]], len(data) - whole

    def close(self) -> None:
        if rest := b"".join(self.pending):
            self._block(rest)
        at = self.written
        self._put(b"".join(self.index))
        self._put(struct.pack("<QI", at, len(self.index)) + TAIL)
        self.stream.close()


class ShardReader:
    """Random access by id position; keeps the last two decoded blocks."""

    def __init__(self, source) -> None:
        import zstandard

        self.file = source
        self.decompress = zstandard.ZstdDecompressor().decompress
        size = source.size()
        head = source.read_at(len(HEAD) + 2, 0)
        foot = source.read_at(16, size - 16)
        if head[: len(HEAD)] != HEAD or foot[12:] != TAIL:
            msg = "not a token shard"
            raise ValueError(msg)
        self.bits = head[len(HEAD)]
        at, n = struct.unpack("<QI", foot[:12])
        entry = struct.Struct(f"<QI{8 * ID_BYTES // self.bits}I")
        self.blocks = list(entry.iter_unpack(source.read_at(size - 16 - at, at))) if n else []
        self.firsts = np.cumsum([0] + [b[1] for b in self.blocks])
        self.held: dict[int, bytes] = {}

    def _block(self, k: int) -> bytes:
        if k not in self.held:
            at, n, *sizes = self.blocks[k]
            data, planes = self.file.read_at(sum(sizes), at), []
            for size in sizes:
                planes.append(self.decompress(data[:size]))
                data = data[size:]
            while len(self.held) > 1:
                self.held.pop(next(iter(self.held)))
            self.held[k] = from_planes(planes, n, self.bits)
        return self.held[k]

    def ids(self, first: int, n: int) -> bytes:
        """Little-endian uint32 bytes of ``n`` ids from position ``first``."""
        out, k = [], int(np.searchsorted(self.firsts, first, "right")) - 1
        while n > 0:
            inside = first - int(self.firsts[k])
            taken = self._block(k)[inside * ID_BYTES : (inside + n) * ID_BYTES]
            got = len(taken) // ID_BYTES
            out.append(taken)
            first, n, k = first + got, n - got, k + 1
        return b"".join(out)


# ---------------------------------------------------------------- Spark side


def write_token_ids(
    df: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    block_ids: int = BLOCK_IDS,
    plane_bits: int = 8,
    level: int = 1,
    chunked: bool = True,
) -> DataFrame:
    """Write shards under ``path`` in ascending id order and return the document index (stored beside them)."""
    spark = df.sparkSession
    uri = qualified_uri(spark, path)
    id_type = df.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("shard", T.StringType()),
            T.StructField("shard_no", T.IntegerType()),
            T.StructField("first", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, root = file_system(uri)
        no = TaskContext.get().partitionId()
        name, writer, position = f"shard-{no:06d}-{uuid.uuid4().hex}.bpids", None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs.create_dir(root, recursive=True)
                writer = ShardWriter(fs.open_output_stream(f"{root}/{name}", compression=None), block_ids, plane_bits, level)
            counts, firsts = [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for ids in encoder(tokenizer_path, chunked).encode(texts):
                writer.add(ids + end)
                counts.append(len(ids) // ID_BYTES + 1)
                firsts.append(position)
                position += counts[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([name] * len(counts), pa.string()),
                    pa.array([no] * len(counts), pa.int32()),
                    pa.array(firsts, pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                names=schema.names,
            )
        if writer is not None:
            writer.close()  # before the task ends: Spark keeps its index rows only then

    ordered = (
        df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(write, schema).write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_token_ids(index: DataFrame, path: str) -> DataFrame:
    """The index with ``ids`` (little-endian uint32 bytes), read back from the shards."""
    uri = qualified_uri(index.sparkSession, path)
    schema = T.StructType([*index.schema.fields, T.StructField("ids", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(uri)
        name, reader = None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "first", "n_tokens")), strict=True)
            found, since, start = [], 0, 0
            for k, (shard, first, n) in enumerate(rows):
                if shard != name:
                    name, reader = shard, ShardReader(fs.open_input_file(f"{root}/{shard}"))
                found.append(reader.ids(first, n))
                since += n * ID_BYTES
                if since >= 16 << 20:  # bounded batches, however long the texts
                    yield _with_ids(batch.slice(start, k + 1 - start), found, schema.names)
                    found, since, start = [], 0, k + 1
            if found:
                yield _with_ids(batch.slice(start), found, schema.names)

    return index.mapInArrow(read, schema)


def _with_ids(batch: pa.RecordBatch, ids: list[bytes], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=names)


def token_stream(index: DataFrame, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the shards."""
    shards = index.groupBy("shard_no").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = shards.select("shard_no", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shard_start"))
    digests = read_token_ids(index, path).select(
        "doc_id", "shard_no", "first", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32")
    )
    return digests.join(shards, "shard_no").select(
        "doc_id", (F.col("shard_start") + F.col("first")).cast("long").alias("start"), "n_tokens", "ids_crc32"
    )


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
