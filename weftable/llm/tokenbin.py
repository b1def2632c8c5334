"""Token ids in a binary format with random access to short documents.

Format: a folder with three tables, written and committed by Spark on any storage it knows.

* ``dictionary``: one row, the zstandard dictionary trained on serialized id arrays, and its hash.
* ``blocks``: ``shard`` and ``block`` number; ``payload``, the documents' compressed frames one after another; the
  offset index as parallel arrays ``ids, offsets, sizes, starts, counts``; ``starts`` are the token ids in the shard ahead of a document;
  ``width``, the bytes of one little-endian id; ``dictionary``, the dictionary's hash.
* Documents ascend by id within and across shards. Every document is a frame by itself, so that one is read by
  its block, offset and size, without touching others.

Defined cases: a null text is empty, and an empty text is the end id alone; null ids come first, equal ids by the hash of
their text; with too few or too small different texts to train on there is no dictionary, and its hash is that of nothing; an empty table gives no blocks.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .hashing import batches
from .interning import ChunkEncoder, gather
from .store import bounded_batches, new_path

END = 0
LEVEL = 3
BLOCK_BYTES = 1 << 18
DICTIONARY_BYTES = 1 << 16
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 20_000
FEWEST_SAMPLES = 50
LEAST_DICTIONARY = 1 << 11
RANGE_BYTES = 1 << 25
MOST_BROADCAST = 1_000_000

#: In texts with other white space than spaces, tabs and line breaks words do not stand for themselves: they are encoded whole.
OTHER_SPACE = re.compile("[\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
ASCII_OTHERS = "\r\v\f\x1c\x1d\x1e\x1f"
JOINED, TOGETHER = 1 << 15, 64  # words encoded at once, and in one text
STORED = 320_000  # chunks, some 60 MB
CUT_CHARS = 1 << 21  # characters of texts that are cut at once

_WHITE, _SIGN, _WORD = (np.zeros(256, dtype=bool) for _ in range(3))
_WHITE[[0x09, 0x0A, 0x20]] = True
_SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_WORD_OF_TWO = np.array([chr(c).isalnum() for c in range(0x800)])  # letters and digits of two bytes

PROBE = "Hello, world. it's été.\n(x) a_b 3.14 c++ d.*** l'homme, «Ωμέγα»: ЖУК!?\n\n e-f \tg\n\"h\" i@j.k#1,000 't\n's 're."


def _cuts(data: bytes, starts: np.ndarray, signs: bool) -> np.ndarray:
    """Where chunks begin in texts that lie one after another from ``starts`` on, as UTF-8.

    A boundary between another character and a space, tab or line break is one between tokens of a byte-level
    tokenizer, whatever surrounds it. With ``signs``, so are those between a letter or digit and an ASCII sign after it, and
    those after a single line break within other characters.
    """
    d = np.frombuffer(data, dtype=np.uint8)
    white = _WHITE[d]
    begins = np.zeros(len(d) + 1, dtype=bool)
    np.logical_and(white[1:], ~white[:-1], out=begins[1:-1])
    if signs:
        at = np.flatnonzero(_SIGN[d])
        at = at[at > 1]
        last, lead = d[at - 1], d[at - 2]
        two = (last >= 0x80) & (lead >= 0xC2) & (lead < 0xE0)
        two &= _WORD_OF_TWO[(lead & 0x1F).astype(np.int64) << 6 | (last & 0x3F)]
        begins[at[_WORD[last] | two]] = True
        at = np.flatnonzero(d[:-1] == 0x0A)
        begins[at[~white[at - 1] & ~white[at + 1]] + 1] = True
    begins[starts] = True
    begins[len(d)] = False
    return np.flatnonzero(begins)


class Encoder:
    """A byte-level tokenizer that encodes each distinct chunk once."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.size = self._tokenizer.get_vocab_size()
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._bytes = np.array([len(self._tokenizer.id_to_token(i) or "") for i in range(self.size)], dtype=np.int64)
        probes = [" the", " Straße", " été", " mañana", " tokenizers", " Ωμέγα", " 日本語", " zzqxv", " ЖУК"]
        self._direct = all(map(np.array_equal, self._encode(probes), self._letters(probes)))
        probe = PROBE.encode()
        at = _cuts(probe, np.zeros(1, dtype=np.int64), True).tolist()
        pieces = [probe[a:b].decode() for a, b in zip(at, [*at[1:], len(probe)], strict=True)]
        self._signs = np.array_equal(self._encode([PROBE])[0], self._encode(pieces)[0])
        self._chunks = ChunkEncoder(self._encode_chunks, most=STORED)

    def _encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks: words of letters by the model, other words after a space many at once, as few texts, cut by their bytes."""
        texts = [c.decode("utf-8", "surrogatepass") for c in chunks]
        sizes = np.zeros(len(texts), dtype=np.int64)
        kinds = np.fromiter(map(self._kind, texts), dtype=np.int8, count=len(texts))
        letters, joined = kinds == 2, kinds == 1
        parts, places = [], []
        words = np.flatnonzero(letters)
        for lo in range(0, len(words), JOINED):
            at = words[lo : lo + JOINED]
            ids, sizes[at] = self._letters([texts[i] for i in at])
            parts.append(ids)
            places.append(at)
        words = np.flatnonzero(joined)
        for lo in range(0, len(words), JOINED):
            at = words[lo : lo + JOINED]
            some = [texts[i] for i in at]
            ids, _ = self._encode(["".join(some[a : a + TOGETHER]) for a in range(0, len(some), TOGETHER)])
            ends = np.cumsum([len(chunks[i]) for i in at])
            bytes_ = np.cumsum(self._bytes[ids])
            cuts = np.searchsorted(bytes_, ends)
            if cuts[-1] >= len(ids) or not np.array_equal(bytes_[cuts], ends):
                joined[at] = False
                continue
            sizes[at] = np.diff(cuts, prepend=-1)
            parts.append(ids)
            places.append(at)
        alone = np.flatnonzero(~(joined | letters))
        if len(alone):
            ids, sizes[alone] = self._encode([texts[i] for i in alone])
            parts.append(ids)
            places.append(alone)
        order = np.concatenate(places)
        starts = np.zeros(len(texts), dtype=np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return gather(np.concatenate(parts), starts, sizes), sizes

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(i) for i in ids], dtype=np.int64)
        return np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum())), sizes

    def _whole(self, text: str) -> bool:
        """Whether a text has white space or marks around which words do not stand for themselves."""
        space = any(c in text for c in ASCII_OTHERS) if text.isascii() else OTHER_SPACE.search(text)
        return bool(space) or any(mark in text for mark in self._special)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        whole = [self._whole(t) for t in texts]
        parts = [b"" if w else t.encode("utf-8", "surrogatepass") for t, w in zip(texts, whole, strict=True)]
        data = b"".join(parts)
        ends = np.cumsum([0, *map(len, parts)])
        at = _cuts(data, ends, self._signs)
        counts = np.diff(np.searchsorted(at, ends))
        found = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)])
        found = found.dictionary_encode()
        out = self._chunks.ids_of(found.dictionary.to_numpy(zero_copy_only=False), found.indices.to_numpy(), counts)
        for i in np.flatnonzero(whole):
            out[i] = self._encode([texts[i]])[0]
        return out

    def _kind(self, chunk: str) -> int:
        """2 for words of letters, bare or after a space, 1 for other words after a space, else 0."""
        word = chunk[1:] if chunk[0] == " " else chunk
        if self._direct and word.isalpha():
            return 2
        return int(word[:1] > " " and word is not chunk and not word[-1].isspace())

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, after a space or bare: they are never cut before the merges, so they go to the model directly."""
        tokenize, ids, sizes = self._tokenizer.model.tokenize, [], []
        for word in _byte_texts(words):
            found = [t.id for t in tokenize(word)]
            sizes.append(len(found))
            ids += found
        return np.array(ids, dtype=np.int32), np.array(sizes, dtype=np.int64)


def _alphabet() -> dict[int, int]:
    """The characters that stand for bytes in a byte-level vocabulary: visible ones of Latin-1 for themselves, others from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + i for i, b in enumerate(hidden)}


_BYTES = np.array([_alphabet().get(b, b) for b in range(256)], dtype="<u2")
_BYTES[0x0A] = 0x0A


def _byte_texts(texts: list[str]) -> list[str]:
    """Texts without line breaks in the characters that stand for their bytes, all at once."""
    data = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return _BYTES[data].tobytes().decode("utf-16-le").split("\n")


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _serialized(texts: list[str], path: str) -> Iterator[tuple[int, bytes]]:
    """Number of ids, with the end id, and their bytes, for each text."""
    encoder = _encoder(path)
    kind = "<u2" if encoder.size <= 1 << 16 else "<u4"
    for ids in encoder(texts):
        yield len(ids) + 1, ids.astype(kind).tobytes() + np.array([END], dtype=kind).tobytes()


def _width(path: str) -> int:
    return 2 if _encoder(path).size <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, text: str, path: str) -> tuple[bytes, int]:
    """A dictionary from a bounded sample, and the bytes of all texts.

    The sample are the ``SAMPLE_DOCS`` different texts of up to ``SAMPLE_CHARS`` characters with the smallest hashes.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"data": [d for _, d in _serialized(f["text"].tolist(), path)]})

    seen = Observation()
    own = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).select("text", F.xxhash64("text").alias("hash"))
    if own.isEmpty():  # there is nothing to observe in a plan without rows
        return b"", 0
    short = F.length("text").between(1, SAMPLE_CHARS)
    observed = own.observe(seen, F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes"))
    few = [r["hash"] for r in observed.filter(short).select("hash").distinct().orderBy("hash").limit(SAMPLE_DOCS).collect()]
    total = int(seen.get["bytes"])
    if len(few) < FEWEST_SAMPLES:
        return b"", total
    chosen = own.filter(short & F.col("hash").isin(few)).groupBy("hash").agg(F.min("text").alias("text"))
    samples = sorted(bytes(r["data"]) for r in chosen.select("text").mapInPandas(work, "data binary").collect())
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    return (zstandard.train_dictionary(size, samples).as_bytes() if size >= LEAST_DICTIONARY else b""), total


def _zdict(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Writes the format. Texts are shuffled once, by ranges of ids of some ``RANGE_BYTES``; a shard is one range."""
    spark = docs.sparkSession
    dictionary, total = train_dictionary(docs, text, path)
    mark = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(mark, bytearray(dictionary))], "hash string, data binary").coalesce(1).write.parquet(
        f"{folder}/dictionary"
    )

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        zdict = _zdict(dictionary)
        compressor = zstandard.ZstdCompressor(level=LEVEL, **({"dict_data": zdict} if zdict else {}))
        width, number, before = _width(path), 0, 0
        ids: list[str | None] = []
        frames_out: list[bytes] = []
        counts: list[int] = []

        def block() -> pd.DataFrame:
            sizes = [len(f) for f in frames_out]
            row = {
                "shard": shard, "block": number, "width": width, "dictionary": mark, "ids": list(ids),
                "offsets": np.cumsum([0, *sizes[:-1]]), "sizes": sizes, "starts": before + np.cumsum([0, *counts[:-1]]),
                "counts": list(counts), "payload": b"".join(frames_out),
            }
            return pd.DataFrame([row])

        held = 0
        for frame in frames:
            texts, keys = frame["text"].tolist(), frame["key"].tolist()
            for lo, hi in batches(texts, CUT_CHARS):
                for k, (n, data) in zip(keys[lo:hi], _serialized(texts[lo:hi], path), strict=True):
                    ids.append(k)
                    counts.append(n)
                    frames_out.append(compressor.compress(data))
                    held += len(frames_out[-1])
                    if held >= BLOCK_BYTES:
                        yield block()
                        number, before, held = number + 1, before + sum(counts), 0
                        ids, frames_out, counts = [], [], []
        if ids:
            yield block()

    schema = (
        "shard int, block int, width int, dictionary string, ids array<string>, "
        "offsets array<long>, sizes array<long>, starts array<long>, counts array<long>, payload binary"
    )
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    order = ["key", F.xxhash64("text")]
    ordered = own.repartitionByRange(ranges, *order).sortWithinPartitions(*order, "text")
    ordered = ordered.select(F.col("key").cast("string").alias("key"), "text")
    with bounded_batches(spark):
        ordered.mapInPandas(work, schema).write.parquet(f"{folder}/blocks")


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if row["hash"] != hashlib.sha256(bytes(row["data"])).hexdigest():
        raise ValueError("the dictionary does not have the hash it is stored under")
    return row["hash"], bytes(row["data"])


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks, with ``base``, the ids in the shards ahead."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum(F.expr("aggregate(counts, 0L, (a, x) -> a + x)")).alias("n")).collect()
    bases, total = [], 0
    for shard, n in sorted(tuple(r) for r in totals):  # as many as there are ranges
        bases.append((shard, total))
        total += n
    base = spark.createDataFrame(bases, "shard int, base long")
    if len(bases) <= MOST_BROADCAST:  # some 12 MB; the blocks, with all of the payload, are not shuffled for it
        base = F.broadcast(base)
    return blocks.join(base, "shard")


def _ids(spark: SparkSession, folder: str):
    """A function from a frame, its width and its dictionary's hash to the ids."""
    mark, data = _dictionary(spark, folder)

    def make():
        zdict = _zdict(data)
        reader = zstandard.ZstdDecompressor(**({"dict_data": zdict} if zdict else {}))

        def ids(frame: bytes | memoryview, width: int, named: str) -> np.ndarray:
            if named != mark:
                raise ValueError("a block names another dictionary")
            return np.frombuffer(reader.decompress(frame), dtype="<u2" if width == 2 else "<u4").astype("<u4")

        return ids

    return make


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of each document, from the files; a block's frames are cut out where it lies."""
    make = _ids(spark, folder)

    def work(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = make()
        for batch in batches_in:
            for row in range(batch.num_rows):
                block = {name: batch.column(name)[row] for name in batch.schema.names}
                payload = memoryview(block["payload"].as_buffer())
                width, named = block["width"].as_py(), block["dictionary"].as_py()
                offsets, sizes, starts, counts = (block[c].values.to_numpy() for c in ("offsets", "sizes", "starts", "counts"))
                crc = []
                for at, size, count in zip(offsets.tolist(), sizes.tolist(), counts.tolist(), strict=True):
                    x = ids(payload[at : at + size], width, named)
                    if len(x) != count:
                        raise ValueError("the index and the ids differ in number")
                    crc.append(zlib.crc32(x))
                columns = [block["ids"].values, pa.array(starts + block["base"].as_py()), pa.array(counts), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "start", "n_tokens", "ids_crc32"])

    blocks = _placed(spark, folder).select("ids", "offsets", "sizes", "starts", "counts", "width", "dictionary", "base", "payload")
    return blocks.mapInArrow(work, "key string, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, folder: str, keys: list) -> dict[str, list[int]]:
    """Ids of a few documents, reading only the blocks that hold them and only their frames."""
    make = _ids(spark, folder)
    wanted = F.array(*[F.lit(str(k)) for k in keys])
    blocks = spark.read.parquet(f"{folder}/blocks").filter(F.arrays_overlap("ids", wanted))
    found = blocks.select(
        "width",
        "dictionary",
        F.explode(
            F.filter(
                F.transform(
                    F.arrays_zip("ids", "offsets", "sizes"),
                    lambda d: F.when(
                        F.array_contains(wanted, d["ids"]),
                        F.struct(d["ids"].alias("key"), F.substring("payload", (d["offsets"] + 1).cast("int"), d["sizes"].cast("int")).alias("frame")),
                    ),
                ),
                lambda d: d.isNotNull(),
            )
        ).alias("d"),
    )
    ids = make()
    return {r["d"]["key"]: ids(bytes(r["d"]["frame"]), r["width"], r["dictionary"]).tolist() for r in found.collect()}


def token_table(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes ``docs`` to a new folder of the shared one and reads them back."""
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")
    write(docs, folder, path, key, text)
    rows = read(spark, folder)
    return rows.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "start", "n_tokens", "ids_crc32")
