"""Operator 7, language-model scoring by cross-entropy difference over words.

Two n-gram models share one vocabulary, the words (lower-cased, split at white
space) of all documents: the target model is counted on the documents of a
target set (the query's: those labelled of good quality), the background model
on all.  With ``order`` n a word's loss after its n - 1 predecessors is

    -log((N(gram) + K * p(word)) / (N(context) + K)),  p(word) = (N(word) + 1) / (N + V)

with the same K and V in both models.  ``score`` is the mean, over a document's
words, of target loss less background loss: low means like the target.

Distinct words, contexts and grams grow with the corpus, so no table of them
goes to the driver or to every task:

1. tasks cut their documents into chunks of about ``CHUNK_WORDS`` words; a
   chunk's distinct words, contexts and grams (64-bit hashes) with their counts
   are sorted and dealt by hash range to buckets, one row per chunk and bucket
   that holds any of its keys: never more rows than keys, so rows and bytes grow
   in proportion to the text.  The chunk's documents, as word numbers, go to a file
   in the shared folder and are not shuffled; a row names file and place;
2. a bucket adds the chunks' counts up and answers with the totals of those keys
   that two or more chunks hold (of all others a chunk knows the totals); it also
   gives its share of N and V.  The answers are written as a table;
3. a chunk's answers meet its documents.  A task that runs again writes a file of
   its own, so a row always names whole data.

Buckets are as many as keep ``BUCKET_BYTES`` of text for each; a key is one
entry per chunk in its bucket, however frequent it is.

Defined results: null or empty texts, and those of white space, have no word,
and null losses and score; a text's first words follow ``order - 1`` start marks;
without any target document the target model is the smoothing alone; target ids
repeat without effect, null ids name none; an empty table gives an empty
result; columns besides the text are kept; rows that repeat an id are scored
each; a text longer than a chunk is one chunk, whole.  The documents must come
out the same if a task runs again.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanpress.llm.common import file_system, scratch_uri
from scanpress.llm.lmscore import narrow_ids

ORDER, SMOOTHING = 2, 8.0
CHUNK_WORDS = 1 << 20
BUCKET_BYTES, LEAST_BUCKETS = 4 << 20, 32
CACHE_WORDS = 200_000
DIGITS = 9
FIELDS = ("n_words", "loss_target", "loss_background", "score")
ROW = "chunk long, bucket int, keys binary, counts binary, docs binary"

_HASHES: dict[str, int] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes, remembered per worker."""
    found = list(map(_HASHES.get, words))
    if None in found:
        if len(_HASHES) > CACHE_WORDS:
            _HASHES.clear()
        for word in set(words).difference(_HASHES):
            _HASHES[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        found = list(map(_HASHES.__getitem__, words))
    return np.array(found, np.uint64)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a pair of hashes (the finalizer of splitmix64)."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order of appearance, their number at each place)."""
    found = pa.array(values).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def keys_of(known: np.ndarray, numbers: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, key numbers of each word's unit, context and gram) of documents laid end to end.

    ``known`` are the hashes of the distinct words, ``numbers`` the words.  Keys of units are odd, all others even;
    a context of one word has that word's key."""
    place = np.arange(len(numbers)) + (order - 1) * np.repeat(np.arange(1, len(lengths) + 1), lengths)
    padded = np.full(len(numbers) + (order - 1) * len(lengths), len(known), np.int64)  # the start mark comes last
    padded[place] = numbers
    hashes = np.append(known, np.uint64(0))
    units = _mixed(np.full(len(hashes), 1, np.uint64), hashes) | np.uint64(1)
    if order == 2:
        contexts, context_at = np.empty(0, np.uint64), padded[place - 1]
        context = hashes[context_at]
    else:
        context = np.full(len(numbers), order, np.uint64)
        for back in range(order - 1, 0, -1):
            context = _mixed(context, hashes[padded[place - back]])
        contexts, context_at = _distinct(context)
        contexts, context_at = _mixed(np.full(len(contexts), 2, np.uint64), contexts) & ~np.uint64(1), context_at + len(units)
    found, gram_at = _distinct(_mixed(context, hashes[numbers]))
    found = _mixed(np.full(len(found), 3, np.uint64), found) & ~np.uint64(1)
    keys = np.concatenate([units, contexts, found])
    by_key = np.argsort(keys)
    rank = np.empty(len(keys), np.int64)
    rank[by_key] = np.arange(len(keys))
    return keys[by_key], rank[np.stack([numbers, context_at, gram_at + (len(units) + len(contexts))])]


def _pack(counts: np.ndarray, width: int = 8) -> bytes:
    """Integers as compressed byte planes."""
    planes = counts.astype(f"<u{width}").reshape(-1).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, rows: int, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(rows, -1).astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, 1)[0].view(np.uint64), dtype=np.uint64)


def _counts(at: np.ndarray, flags: np.ndarray, lengths: np.ndarray, n_keys: int) -> np.ndarray:
    """Counts of each key (rows: as unit or gram in all documents, in targets; as context in all, in targets)."""
    own, sums = np.repeat(flags, lengths), []
    for places in (at[[0, 2]].reshape(-1), at[1]):
        weights = np.tile(own, len(places) // max(len(own), 1))
        sums += [np.bincount(places, weights=w, minlength=n_keys) for w in (None, weights)]
    return np.stack(sums).astype(np.int64)


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's hash range begins among sorted keys, and the end."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))


def _stream(rows: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write(rows)
    return sink.getvalue().to_pybytes()


def _asked(order: int, buckets: int, chunk_words: int, folder: str):
    """Rows of (kept columns, text, is_target) to the requests of each chunk and the place of its documents."""

    def rows_of(chunk: int, name: str, sink: pa.NativeFile, kept: pa.RecordBatch, flags: np.ndarray, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(w) for w in held], np.int64)
        known, numbers = _distinct(np.concatenate(held))
        keys, at = keys_of(known, numbers, lengths, order)
        sums, cuts = _counts(at, flags, lengths, len(keys)), _cuts(keys, buckets)
        own = np.flatnonzero(np.diff(cuts)).tolist()
        packed = [(_pack_keys(keys[cuts[b] : cuts[b + 1]]), _pack(sums[:, cuts[b] : cuts[b + 1]], 4), None) for b in own]
        part = pa.Table.from_batches([kept]).append_column("", pa.array(flags)).append_column("", pa.array(lengths))
        held_rows = pa.record_batch([[known.tobytes()], [_pack(numbers, 4)], [_stream(part)]], names=["known", "numbers", "docs"])
        data, first = _stream(held_rows), sink.tell()
        sink.write(data)
        home = int(_mixed(np.array([chunk], np.uint64), np.zeros(1, np.uint64))[0]) % buckets  # chunk numbers share their low bits
        packed.append((None, None, f"{name} {first} {len(data)}".encode()))
        columns = [pa.array([chunk] * len(packed), pa.int64()), pa.array([*own, home], pa.int32())]
        columns += [pa.array(c, pa.binary()) for c in zip(*packed, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "keys", "counts", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, sink, (fs, root) = TaskContext.get().partitionId() << 33, None, file_system(folder)
        name = f"chunks-{chunk >> 33:06d}-{uuid4().hex}"
        for batch in batches:
            if sink is None:
                fs.create_dir(root, recursive=True)
                sink = fs.open_output_stream(f"{root}/{name}", compression=None)
            texts = batch.column(batch.num_columns - 2)
            flags = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.float64)
            kept = batch.select(list(range(batch.num_columns - 2)))
            first, held, n = 0, [], 0
            for k, text in enumerate(texts):
                held.append(word_hashes((text.as_py() or "").lower().split()))
                n += len(held[-1])
                if n >= chunk_words or k + 1 == len(texts):
                    yield from rows_of(chunk, name, sink, kept.slice(first, k + 1 - first), flags[first : k + 1], held)
                    chunk, first, held, n = chunk + 1, k + 1, [], 0
        if sink is not None:
            sink.close()  # before the task ends: Spark keeps its rows only then

    return run


def _answered(names: list[str]):
    """A bucket's requests with the totals of the keys that other chunks hold too, and its documents' rows."""

    def run(table: pa.Table) -> pa.Table:
        is_request = table.column("docs").is_null()
        requests, docs = table.filter(is_request), table.filter(pc.invert(is_request))
        own = [_unpack_keys(k) for k in requests.column("keys").to_pylist()]
        keys, at = np.unique(np.concatenate(own or [np.empty(0, np.uint64)]), return_inverse=True)
        shared = np.bincount(at, minlength=len(keys)) > 1
        totals, first = np.zeros((4, len(keys)), np.int64), 0
        for k, c in zip(own, requests.column("counts").to_pylist(), strict=True):
            totals[:, at[first : first + len(k)]] += _unpack(c, 4, 4)  # a chunk's keys are distinct
            first += len(k)
        found, first = [], 0
        for chunk, k in zip(requests.column("chunk").to_pylist(), own, strict=True):
            places = at[first : first + len(k)]
            first += len(k)
            some = shared[places]
            if some.any():
                found.append((chunk, np.packbits(some).tobytes(), _pack(totals[:, places[some]]), None))
        answers = pa.table(
            [
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([table.column("bucket")[0].as_py()] * len(found), pa.int32()),
                *[pa.array([f[k] for f in found], pa.binary()) for k in (1, 2, 3)],
            ],
            names=names,
        )
        return pa.concat_tables([answers, docs.rename_columns(names).cast(answers.schema)])

    return run


def _word_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch (text, is_target): its distinct words' keys, and a row without key with its numbers of words."""
    for batch in batches:
        held = [word_hashes((text.as_py() or "").lower().split()) for text in batch.column(0)]
        lengths = np.array([len(w) for w in held], np.int64)
        flags = batch.column(1).to_numpy(zero_copy_only=False)
        keys = _distinct(np.concatenate(held or [np.empty(0, np.uint64)]))[0].view(np.int64)
        n = [np.append(np.zeros(len(keys), np.int64), x) for x in (lengths.sum(), lengths[flags].sum())]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(keys, 0), mask=np.arange(len(keys) + 1) == len(keys)), *map(pa.array, n)], names=["key", "n", "n_target"])


def _scored(order: int, smoothing: float, buckets: int, tokens: tuple[int, int], words: int, folder: str, names: list[str]):
    """A chunk's documents with their losses."""

    def run(table: pa.Table) -> pa.Table:
        is_answer = table.column("docs").is_null()
        place, answers = table.filter(pc.invert(is_answer)).column("docs")[0].as_py().decode().split(), table.filter(is_answer)
        fs, root = file_system(folder)
        with fs.open_input_file(f"{root}/{place[0]}") as file:
            doc = pa.ipc.open_stream(file.read_at(int(place[2]), int(place[1]))).read_all().to_pylist()[0]
        kept = pa.ipc.open_stream(doc["docs"]).read_all()
        flags, lengths = (kept.column(kept.num_columns - k).to_numpy() for k in (2, 1))
        keys, at = keys_of(np.frombuffer(doc["known"], np.uint64), _unpack(doc["numbers"], 1, 4)[0], lengths, order)
        totals, cuts = _counts(at, flags, lengths, len(keys)), _cuts(keys, buckets)
        for b, mask, c in zip(*(answers.column(name).to_pylist() for name in ("bucket", "keys", "counts")), strict=True):
            some = np.unpackbits(np.frombuffer(mask, np.uint8), count=int(cuts[b + 1] - cuts[b]))
            totals[:, cuts[b] + np.flatnonzero(some)] = _unpack(c, 4)
        rows, some = np.repeat(np.arange(len(lengths)), lengths), lengths > 0
        means = []
        for own, contexts, n in zip(totals[:2], totals[2:], tokens, strict=True):
            unit, context, gram = own[at[0]], contexts[at[1]], own[at[2]]
            p = (unit + 1) / max(n + words, 1)
            loss = -np.log((gram + smoothing * p) / (context + smoothing))
            means.append(np.bincount(rows, weights=loss, minlength=len(lengths)) / np.maximum(lengths, 1))
        background, target = means
        columns = [np.round(x, DIGITS) for x in (target, background, target - background)]
        columns = [pa.array(lengths, pa.int64()), *[pa.array(c, pa.float64(), mask=~some) for c in columns]]
        return pa.table([*kept.columns[:-2], *columns], names=names)

    return run


def bucket_count(df: DataFrame, text_col: str = "text") -> int:
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))


def score_words(
    df: DataFrame,
    target_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    smoothing: float = SMOOTHING,
    chunk_words: int = CHUNK_WORDS,
    buckets: int | None = None,
) -> DataFrame:
    """The columns of ``df`` but the text, n_words, loss_target, loss_background, score."""
    targets = narrow_ids(target_ids.select(F.col("id").alias("__target")).filter("__target IS NOT NULL").distinct())
    kept = [c for c in df.columns if c != text_col]
    docs = df.join(targets, df[id_col] == targets["__target"], "left")
    docs = docs.select(*[df[c] for c in kept], df[text_col], F.col("__target").isNotNull().alias("__is_target"))
    buckets = buckets or bucket_count(df, text_col)
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(FIELDS[0], T.LongType()), *[T.StructField(f, T.DoubleType()) for f in FIELDS[1:]]])
    folder = scratch_uri(df.sparkSession, "word-chunks")
    asked = docs.mapInArrow(_asked(order, buckets, chunk_words, folder), ROW)
    names = [f.split()[0] for f in ROW.split(", ")]
    answers = asked.groupBy("bucket").applyInArrow(_answered(names), ROW)
    words = docs.select(text_col, "__is_target").mapInArrow(_word_facts, "key long, n long, n_target long")
    words = words.groupBy("key").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))
    n, n_target, distinct = words.agg(F.sum("n"), F.sum("n_target"), F.count("key")).first()
    score = _scored(order, smoothing, buckets, (n or 0, n_target or 0), distinct, folder, schema.names)
    return answers.groupBy("chunk").applyInArrow(score, schema)
