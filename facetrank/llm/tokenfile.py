"""Token files: ids compressed per document with one shared dictionary.

A shard is the image of one binary file:

    magic (6 bytes), id width (1), dictionary hash (32, sha256), documents (u64),
    ids of the bucket before this shard (u64),
    doc_ids (i64 each), known flags (u8 each: 0 for a null id), id counts (u64 each),
    frame ends (u64 each), then one zstandard frame per document.

All numbers are little-endian. Any document is read alone: its frame lies between
two ends, and the dictionary makes short frames small. Shards are rows of a
Parquet folder with their bucket and place, so that every store that Spark
writes to can hold them and Spark's committer keeps failed tasks out of it.

Documents are encoded once, dealt out by ranges of their order (doc_id, or a key the
caller gives), sorted and packed as a stream. ``start`` is the sum of earlier buckets
plus the place in the bucket.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import tokenizers
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetrank.llm.common import freed_shuffles, hash_bounds, in_arrow, shuffle_partitions
from facetrank.llm.words import parts_of

MAGIC = b"TOKS1\n"
HEAD = struct.Struct("<6sB32sQQ")
END_ID = 1
SHARD_BYTES = 8 << 20
LEVEL = 3
# The dictionary is trained on at most so many documents of at most so many bytes.
SAMPLE_DOCS = 1_000
SAMPLE_DOC_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
# Words whose ids a worker remembers; more only spare time.
WORDS_KEPT = 600_000
_TEXT_BYTES = 1 << 20
_JOINED_WORDS = 256
# A run of these after letters is a piece of its own.
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class WordEncoder:
    """Ids of whole texts, put together from the ids of their words.

    White space ends every word of this kind of tokenizer (lower case, white
    space dropped, words split at letter borders), so a text's ids are those of
    its words in order. Words are kept with their ids; new ones are encoded by
    the library together. A text with a special token's opening is encoded whole.
    """

    def __init__(self, definition: str):
        self.tokenizer = tokenizers.Tokenizer.from_str(definition)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.words: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _learn_letters(self, words: list[bytes]) -> None:
        """Words of letters only: each ends at its own end mark."""
        groups = [words[at : at + _JOINED_WORDS] for at in range(0, len(words), _JOINED_WORDS)]
        texts = [b" ".join(group).decode() for group in groups]
        width = self.kind.itemsize
        for group, found in zip(
            groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True
        ):
            ids = np.array(found.ids, self.kind)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * width).tolist()
            if len(cuts) == len(group):
                data = ids.tobytes()
                parts = [data[i:j] for i, j in zip([0, *cuts], cuts, strict=False)]
            else:  # some letter is not one to the tokenizer
                parts = [self._encode(word.decode()).tobytes() for word in group]
            self.words.update(zip(group, parts, strict=True))

    def learn(self, words: set[bytes]) -> None:
        """Keep the ids of new words: letters and then marks are looked up apart."""
        letters, marked = set(), []
        for word in words:
            core = word.rstrip(_MARKS)
            if core and core.decode(errors="replace").isalpha():
                letters.add(core)
                if len(core) < len(word):
                    marked.append((word, core, word[len(core) :]))
            else:
                self.words[word] = self._encode(word.decode(errors="replace")).tobytes()
        self._learn_letters([w for w in letters if w not in self.words])
        for word, core, marks in marked:
            if marks not in self.words:
                self.words[marks] = self._encode(marks.decode()).tobytes()
            self.words[word] = self.words[core] + self.words[marks]

    def keep_words(self, most: int) -> None:
        """Forget the words known so far if there are more."""
        if len(self.words) > most:
            self.words.clear()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Serialized ids of each text, without an end id."""
        self.keep_words(WORDS_KEPT)
        split = [[] if b"<|" in text else text.lower().split() for text in texts]
        ids = [list(map(self.words.get, words)) for words in split]
        gaps = [
            (words, own, [k for k, known in enumerate(own) if known is None])
            for words, own in zip(split, ids, strict=True)
            if None in own
        ]
        self.learn({words[k] for words, _, places in gaps for k in places})
        for words, own, places in gaps:
            for k in places:
                own[k] = self.words[words[k]]
        return [
            self._encode(text.decode(errors="replace")).tobytes() if b"<|" in text else b"".join(own)
            for text, own in zip(texts, ids, strict=True)
        ]


_encoders: dict[bytes, WordEncoder] = {}


def worker_encoder(definition: str) -> WordEncoder:
    """One per worker process, so that its words outlive a task."""
    key = hashlib.sha256(definition.encode()).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(definition)
    return _encoders[key]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _with_ids(batches, definition: str, words_kept: int):
    """Parts of batches with their serialized ids, end id included."""
    encoder = worker_encoder(definition)
    end = np.array([END_ID], encoder.kind).tobytes()
    for batch in batches:
        for part in parts_of(batch, 1, _TEXT_BYTES):
            encoder.keep_words(words_kept)
            texts = part.column(1).to_pylist()
            yield part, [ids + end for ids in encoder.encode(texts)], encoder.kind.itemsize


def _sampler(definition):
    def run(batches):
        for part, rows, _ in _with_ids(batches, definition.value, SAMPLE_DOCS):
            short = [ids if len(ids) <= SAMPLE_DOC_BYTES else None for ids in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(short, pa.binary())], ["doc_id", "ids"]
            )

    return run


def train_dictionary(docs: DataFrame, definition) -> bytes:
    """Dictionary bytes from the sampled documents; empty if there are too few."""
    short = _source(docs).where(F.octet_length("text") <= SAMPLE_DOC_BYTES)
    number = F.xxhash64("doc_id", "text")
    for bound in hash_bounds(short.count(), SAMPLE_DOCS):
        sampled = short.where(number <= bound).orderBy(number, "doc_id").limit(SAMPLE_DOCS)
        found = in_arrow(sampled, _sampler(definition), "doc_id bigint, ids binary").collect()
        if len(found) == SAMPLE_DOCS:
            break
    rows = [bytes(r.ids) for r in found if r.ids]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(rows)).as_bytes()
    except zstandard.ZstdError:  # too few or too even samples
        return b""


def _compressor(definition, dictionary, bounds, words_kept: int):
    def run(batches):
        data = _dictionary(dictionary.value)
        zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False)
        edges = np.array(bounds.value, np.int64)
        for part, rows, width in _with_ids(batches, definition.value, words_kept):
            place = part.column(2)
            known = np.array(place.is_valid())
            places = np.array(place.fill_null(0)).astype(np.int64)
            buckets = np.where(known, np.searchsorted(edges, places), 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(buckets, pa.int32()),
                    place,
                    part.column(0),
                    pa.array([len(r) // width for r in rows], pa.int64()),
                    pa.array([width] * len(rows), pa.int32()),
                    pa.array(list(map(zstd.compress, rows)), pa.binary()),
                ],
                ["bucket", "place", "doc_id", "n_tokens", "width", "frame"],
            )

    return run


def pack(width: int, dictionary_hash: bytes, start: int, rows: list[tuple]) -> bytes:
    """A shard's bytes from ``(doc_id or None, id count, frame)``."""
    doc_ids, counts, frames = zip(*rows, strict=True)
    ends = np.cumsum([len(f) for f in frames])
    return b"".join(
        [
            HEAD.pack(MAGIC, width, dictionary_hash, len(rows), start),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is not None for d in doc_ids], "u1").tobytes(),
            np.array(counts, "<u8").tobytes(),
            ends.astype("<u8").tobytes(),
            *frames,
        ]
    )


class Shard:
    """Reads documents of a shard's bytes, each alone."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, width, digest, self.count, self.start = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        at, n = HEAD.size, self.count
        doc_ids = np.frombuffer(data, "<i8", n, at)
        known = np.frombuffer(data, "u1", n, at + 8 * n)
        self.doc_ids = [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)]
        self.counts = np.frombuffer(data, "<u8", n, at + 9 * n).astype(np.int64)
        self.ends = np.frombuffer(data, "<u8", n, at + 17 * n).astype(np.int64)
        self.base = at + 25 * n
        self.data = memoryview(data)
        self.kind = np.dtype(f"<u{width}")
        self.zstd = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, i: int) -> np.ndarray:
        first = self.base + (int(self.ends[i - 1]) if i else 0)
        frame = self.data[first : self.base + int(self.ends[i])]
        return np.frombuffer(self.zstd.decompress(frame), self.kind)


_SHARDS = "bucket int, shard int, n_ids bigint, file binary"


def _packer(dictionary):
    def run(batches):
        digest = hashlib.sha256(dictionary.value).digest()
        bucket, shard, start, held, size, width = None, 0, 0, [], 0, 0

        def flush():
            total = sum(r[1] for r in held)
            return total, pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket], pa.int32()),
                    pa.array([shard], pa.int32()),
                    pa.array([total], pa.int64()),
                    pa.array([pack(width, digest, start, held)], pa.binary()),
                ],
                ["bucket", "shard", "n_ids", "file"],
            )

        for batch in batches:
            for number, doc_id, count, width_now, frame in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if held and (number != bucket or size >= SHARD_BYTES):
                    total, out = flush()
                    yield out
                    start, shard, held, size = start + total, shard + 1, [], 0
                if number != bucket:
                    bucket, shard, start = number, 0, 0
                width = width_now
                held.append((doc_id, count, frame))
                size += len(frame)
        if held:
            yield flush()[1]

    return run


def _source(docs: DataFrame, order: Column | None = None) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        (F.col("doc_id") if order is None else order).cast("bigint").alias("place"),
    )


def write(
    docs: DataFrame,
    path: str,
    definition: str,
    order: Column | None = None,
    words_kept: int = WORDS_KEPT,
) -> None:
    """Write ``docs`` as token files below ``path``, in ascending doc_id order.

    ``definition`` is the JSON text of a tokenizer of this kind. Null doc_ids come
    first; rows that repeat a doc_id stand side by side, ordered by their ids.
    With ``order``, a bigint of the rows of ``docs``, rows follow it first, nulls
    before all others, and then their doc_id. Null and empty texts are the end id
    alone. Other columns are ignored. A worker remembers the ids of about
    ``words_kept`` words, which costs it some 400 bytes each.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    shared = spark.sparkContext.broadcast(definition)
    dictionary = spark.sparkContext.broadcast(train_dictionary(docs, shared))
    source = _source(docs, order)
    quantiles = [i / parts for i in range(1, parts)] or [0.5]
    found = source.agg(F.percentile_approx("place", quantiles)).first()[0]
    bounds = spark.sparkContext.broadcast(sorted(set(found or [])))
    frames = in_arrow(
        source,
        _compressor(shared, dictionary, bounds, words_kept),
        "bucket int, place bigint, doc_id bigint, n_tokens bigint, width int, frame binary",
    )
    dealt = (
        frames.repartition(parts, "bucket")
        .sortWithinPartitions(
            "bucket", F.asc_nulls_first("place"), F.asc_nulls_first("doc_id"), "n_tokens", "frame"
        )
        .drop("place")
    )
    with freed_shuffles(spark):
        in_arrow(dealt, _packer(dictionary), _SHARDS).write.parquet(f"{path}/shards")
        spark.createDataFrame(
            [(hashlib.sha256(dictionary.value).hexdigest(), dictionary.value)],
            "sha256 string, dictionary binary",
        ).coalesce(1).write.parquet(f"{path}/dictionary")


def _digester(dictionary):
    def run(batches):
        for batch in batches:
            for offset, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = Shard(data, dictionary.value)
                starts = offset + shard.start + np.cumsum(shard.counts) - shard.counts
                sums = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in range(shard.count)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(shard.counts, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def _decoder(dictionary):
    def run(batches):
        for batch in batches:
            for _, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = Shard(data, dictionary.value)
                for i in range(shard.count):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard.doc_ids[i]], pa.int64()),
                            pa.array([shard.ids(i).tolist()], pa.list_(pa.int32())),
                        ],
                        ["doc_id", "ids"],
                    )

    return run


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, object]:
    """Shards with the ids of earlier buckets, and the dictionary."""
    stored = spark.read.parquet(f"{path}/dictionary").first().dictionary
    shards = spark.read.parquet(f"{path}/shards")
    # A row per bucket; there are as many as there were shuffle partitions.
    totals = shards.groupBy("bucket").agg(F.sum("n_ids").alias("n")).orderBy("bucket").collect()
    offsets, before = [], 0
    for row in totals:
        offsets.append((row.bucket, before))
        before += row.n
    known = spark.createDataFrame(offsets, "bucket int, offset bigint")
    placed = shards.join(F.broadcast(known), "bucket").select("offset", "file")
    return placed, spark.sparkContext.broadcast(bytes(stored))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    placed, dictionary = _opened(spark, path)
    return in_arrow(
        placed, _digester(dictionary), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (end id included) of every document of the files."""
    placed, dictionary = _opened(spark, path)
    return in_arrow(placed, _decoder(dictionary), "doc_id bigint, ids array<int>")
