"""Token-id files: fixed-size id blocks cut into bit planes, each plane compressed with zstandard, and a chunk index.

Documents are range-partitioned and sorted by id; each partition writes its chunks in order through Spark's
Parquet writer, so a lost task leaves no half file. A chunk holds whole documents. Its payload is

    magic 4 bytes | ids u32 | ids per block u32 | planes u8 | size of each plane u32 ... | the planes

little-endian; plane ``p`` holds bit ``p`` of every id, block after block, eight ids a byte, the last block filled
with zeros to a whole byte. Beside the payload stand the ids and lengths of the chunk's documents. The chunk
index, a small table of its own, has for every chunk its shard, number and the position of its first id.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F
from tokenizers import Tokenizer

from kinweave.llm.common import Generations, by_batch, returning_memory, small_batches
from kinweave.session import scratch_path, ship_package

MAGIC = b"IDP1"
# Ids in a block and, about, in a chunk.
BLOCK, CHUNK = 8_192, 262_144
# Words a worker remembers per generation.
REMEMBERED = 400_000
# New words in one call of the tokenizer.
WORDS_TOGETHER = 2_000
SCHEMA = "shard int, chunk int, n_ids long, doc_ids array<long>, doc_lengths array<long>, payload binary"


def to_planes(ids: np.ndarray, n_planes: int, block: int = BLOCK) -> list[bytes]:
    """Bit ``p`` of all ids, for each ``p`` below ``n_planes``."""
    out: list[list[bytes]] = [[] for _ in range(n_planes)]
    places = np.arange(n_planes, dtype=np.uint16 if n_planes <= 16 else np.uint32)[:, None]
    for i in range(0, len(ids), block):
        part = ids[i : i + block].astype(np.uint16 if n_planes <= 16 else np.uint32)
        packed = np.packbits((part[None, :] >> places & 1).astype(np.uint8), axis=1, bitorder="little")
        for p in range(n_planes):
            out[p].append(packed[p].tobytes())
    return [b"".join(p) for p in out]


def from_planes(planes: list[bytes], n_ids: int, block: int = BLOCK) -> np.ndarray:
    """The ids of :func:`to_planes`."""
    ids = np.empty(n_ids, "<u4")
    flat = [np.frombuffer(p, np.uint8) for p in planes]
    at = 0
    for i in range(0, n_ids, block):
        n = min(block, n_ids - i)
        size = (n + 7) // 8
        bits = np.unpackbits(np.stack([f[at : at + size] for f in flat]), axis=1, bitorder="little", count=n)
        out = np.zeros(n, np.uint32)
        for p, plane in enumerate(bits):
            out |= plane.astype(np.uint32) << np.uint32(p)
        ids[i : i + n] = out
        at += size
    return ids


def pack(ids: np.ndarray, n_planes: int, block: int = BLOCK) -> bytes:
    """The payload of one chunk."""
    if len(ids) and int(ids.max()) >> n_planes:
        raise ValueError(f"an id needs more than {n_planes} bit planes")
    squeeze = zstandard.ZstdCompressor(level=3).compress
    planes = [squeeze(p) for p in to_planes(ids, n_planes, block)]
    head = struct.pack("<4sIIB", MAGIC, len(ids), block, n_planes) + struct.pack(f"<{n_planes}I", *map(len, planes))
    return head + b"".join(planes)


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a chunk's payload."""
    magic, n_ids, block, n_planes = struct.unpack_from("<4sIIB", payload)
    if magic != MAGIC:
        raise ValueError("not a chunk of token ids")
    sizes = struct.unpack_from(f"<{n_planes}I", payload, 13)
    at, planes, expand = 13 + 4 * n_planes, [], zstandard.ZstdDecompressor().decompress
    for size in sizes:
        planes.append(expand(payload[at : at + size]) if n_ids else b"")
        at += size
    return from_planes(planes, n_ids, block)


def _parted(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words without a full stop or comma at their end, and which it was: 1 a stop, 2 a comma, 0 none was cut off.

    The tokenizer cuts there anyway if a letter or digit stands before, and makes all letters small except in special
    tokens, which hold a bar.
    """
    marked = pc.match_substring_regex(words, r"[0-9A-Za-z][.,]\z")
    marks = np.where(marked.to_numpy(zero_copy_only=False), np.where(pc.ends_with(words, ".").to_numpy(zero_copy_only=False), 1, 2), 0)
    base = pc.replace_substring_regex(words, r"([0-9A-Za-z])[.,]\z", r"\1")
    plain = pc.and_(pc.string_is_ascii(base), pc.invert(pc.match_substring(base, "|")))
    return pc.if_else(plain, pc.ascii_lower(base), base), marks


class WordEncoder:
    """Encodes whole texts with a tokenizer that drops white space, as its plain call does; each distinct word is encoded once.

    The tokenizer works on the parts between ASCII white space independently, so the ids of a text are those of its words in
    turn, a last full stop or comma apart. That holds for a tokenizer whose pre-tokenizer cuts letters, digits and signs apart, drops white
    space and makes letters small; another one is refused unless a probe gives its own ids. Texts are split, and their words told apart, in
    Arrow; Python sees each distinct word of a batch once, and ids are taken for all words at once.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.words = Generations(REMEMBERED)
        self.marks = np.frombuffer(b"".join(self._encode_words([".", ","])), "<u4")
        probe = "Don't, say: A1b2, \x0b ÉCOLE. x.y,\t<|Endoftext|>. 3,5.\r\n ßtraße, 日本."
        if len(self.marks) != 2 or self.one(probe) != self.tokenizer.encode(probe, add_special_tokens=False).ids:
            raise ValueError("this tokenizer does not work on words between white space independently")

    def one(self, text: str) -> list[int]:
        return self(pa.array([text]))[0].tolist()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids of each. Null texts are empty."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        words = split.flatten().dictionary_encode()
        base, mark = _parted(words.dictionary)
        base = base.dictionary_encode()
        known = self._known(base.dictionary.to_pylist())
        table = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *(len(k) // 4 for k in known)]), pa.int32()), pa.array(np.frombuffer(b"".join(known), "<u4"))
        )
        at, mark = base.indices.take(words.indices), mark[words.indices.to_numpy()]
        lengths = table.value_lengths().take(at).to_numpy()
        marked = np.flatnonzero(mark)
        ids = np.insert(table.take(at).flatten().to_numpy(), np.cumsum(lengths)[marked], self.marks[mark[marked] - 1])
        upto = np.concatenate([[0], np.cumsum(lengths + (mark > 0))])
        return ids, np.diff(upto[split.offsets.to_numpy() - split.offsets[0].as_py()])

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        self.words.turn()
        known = self.words.young
        new = [w for w in words if w and w not in known and not self.words.revive(w)]
        for i in range(0, len(new), WORDS_TOGETHER):
            part = new[i : i + WORDS_TOGETHER]
            known.update(zip(part, self._encode_words(part)))
        return [known[w] if w else b"" for w in words]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, from one call on all of them; a token's place tells its word."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in words])
        owner = np.searchsorted(ends, [start for start, _ in found.offsets], "right")
        upto = [0, *(4 * np.searchsorted(owner, np.arange(len(words)), "right")).tolist()]
        flat = np.array(found.ids, "<u4").tobytes()
        return [flat[a:b] for a, b in zip(upto, upto[1:])]


_encoders: dict[int, WordEncoder] = {}


def _encoder(definition: str) -> WordEncoder:
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(definition)
    return _encoders[key]


def _text_blocks(batch: pa.RecordBatch, limit: int = 8_000_000) -> Iterable[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
    block = np.cumsum(sizes) // limit
    starts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield batch.slice(a, b - a)


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, n_planes: int,
    id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, chunk: int = CHUNK,
) -> None:
    """Encode every whole text, append ``end_id`` to each, and write files in ascending document id below ``path``.

    A null text counts as empty, a null id comes first, repeated ids stand side by side. Ids are cast to long. Rows of one id are
    range-partitioned by a hash of their text, so none but equal rows must share a task.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    if len(definition) > 64 << 20:
        raise ValueError(f"{tokenizer} has more than 64 MiB")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, number = _encoder(definition), TaskContext.get().partitionId(), 0
        doc_ids, parts, size = [], [], 0

        def made() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                    pa.array([pack(ids, n_planes, block)], pa.binary()),
                ],
                names=["shard", "chunk", "n_ids", "doc_ids", "doc_lengths", "payload"],
            )

        for batch in batches:
            for some in _text_blocks(batch):
                ids, lengths = encode(some.column(1))
                ends = np.cumsum(lengths)
                ids = np.insert(ids, ends, end_id)
                ends += np.arange(1, len(ends) + 1)
                for key, begin, end in zip(some.column(0).to_pylist(), (ends - lengths - 1).tolist(), ends.tolist()):
                    doc_ids.append(key)
                    parts.append(ids[begin:end])
                    size += end - begin
                    if size >= chunk:
                        yield made()
                        doc_ids, parts, size, number = [], [], 0, number + 1
        if doc_ids:
            yield made()

    # The hash settles the order of rows with the same id, so a task that runs again writes the same.
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .withColumn("hash", F.xxhash64("text")).repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash").drop("hash")
    )
    small_batches(docs.sparkSession)
    written = ordered.mapInArrow(returning_memory(run), SCHEMA)
    written.write.mode("overwrite").parquet(f"{path}/chunks")
    chunks = docs.sparkSession.read.schema(SCHEMA).parquet(f"{path}/chunks")
    index = chunks.select("shard", "chunk", "n_ids", F.size("doc_ids").alias("n_docs"))
    # One row per shard and one per chunk: their running sums are small tables.
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("_n")).select(
        "shard", (F.sum("_n").over(W.orderBy("shard")) - F.col("_n")).alias("_before")
    )
    in_shard = F.sum("n_ids").over(W.partitionBy("shard").orderBy("chunk")) - F.col("n_ids")
    index.join(shards, "shard").select("shard", "chunk", "n_ids", "n_docs", (F.col("_before") + in_shard).alias("first")).write.mode(
        "overwrite"
    ).parquet(f"{path}/index")


def read(spark, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids binary)`` of the files below ``path``; ids are little-endian, unsigned, 32 bits.

    Chunks are unpacked where they are read; only ids and positions meet the chunk index in a join.
    """
    return _documents(spark, path, lambda ids: pa.array(ids, pa.binary()), "ids", "binary")


def checksums(spark, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of the files below ``path``."""
    return _documents(spark, path, lambda ids: pa.array([zlib.crc32(i) for i in ids], pa.int64()), "ids_crc32", "long")


def _documents(spark, path: str, value, name: str, kind: str) -> DataFrame:
    def make():
        def run(batch: pa.RecordBatch):
            for row in range(batch.num_rows):
                shard, chunk, doc_ids, lengths, payload = (c[row].as_py() for c in batch.columns)
                ids = unpack(payload)
                ends = np.cumsum(np.array(lengths, np.int64))
                n = len(doc_ids)
                flat = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * n, pa.int32()), pa.array([chunk] * n, pa.int32()), pa.array(doc_ids, pa.int64()),
                        pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                        value([flat[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), lengths)]),
                    ],
                    names=["shard", "chunk", "doc_id", "offset", "n_tokens", name],
                )

        return run

    chunks = spark.read.schema(SCHEMA).parquet(f"{path}/chunks")
    docs = by_batch(
        chunks.select("shard", "chunk", "doc_ids", "doc_lengths", "payload"), make,
        f"shard int, chunk int, doc_id long, offset long, n_tokens long, {name} {kind}",
    )
    index = spark.read.schema("shard int, chunk int, n_ids long, n_docs int, first long").parquet(f"{path}/index")
    return docs.join(index.select("shard", "chunk", "first"), ["shard", "chunk"]).select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", name
    )


def write_and_check(docs: DataFrame, tokenizer: str, end_id: int, n_planes: int) -> DataFrame:
    """Write the files to the shared folder, read them back, and return :func:`checksums`."""
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer, end_id, n_planes)
    return checksums(docs.sparkSession, path)
