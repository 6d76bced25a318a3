"""Byte-level BPE: encoding and decoding by DuckDB statements inside each task.

A task splits its texts by the pre-token pattern and keeps every distinct piece once. Pieces new to the
worker go to an in-process DuckDB as token-position rows: a recursive query joins neighbouring tokens with the
merge table, contracts each piece's leftmost pair of the smallest rank, and repeats until no piece has a pair
left. Decoding joins id rows with the vocabulary and concatenates their bytes by an ordered aggregation, cut by token lengths.
Documents are independent, so the job has no shuffle, and a lost executor costs its tasks only. A task makes its codec and
lets go of it at its end, since idle workers stand beside the next stage's memory.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.common import Generations, by_batch

# Pieces of more bytes are contracted by a loop of statements, see _encode_long.
LONG_BYTES = 1_000
# Token-position rows in one statement, and pieces and chunks a task remembers per generation.
ROWS_PER_STATEMENT = 250_000
REMEMBERED = 200_000

ENCODE = """
WITH RECURSIVE state(piece, ids) AS (
    SELECT piece, ids FROM start
    UNION ALL
    (WITH positions AS (
              SELECT piece, unnest(range(1, len(ids))) AS pos, unnest(ids[:-2]) AS here, unnest(ids[2:]) AS nxt FROM state),
          first AS (
              SELECT p.piece, min((m.merged::BIGINT << 32) | p.pos) AS best
              FROM positions p JOIN merges m ON m.pair = ((p.here::BIGINT << 32) | p.nxt) GROUP BY p.piece)
     SELECT piece, list_concat(
                list_append(ids[:(best & 4294967295) - 1], (best >> 32)::INTEGER), ids[(best & 4294967295) + 2:])
     FROM first JOIN state USING (piece))
)
SELECT piece, arg_min(ids, len(ids)) AS ids FROM state GROUP BY piece ORDER BY piece
"""

DECODE = """
SELECT string_agg(bytes, '') FROM (SELECT v.bytes FROM tokens t JOIN vocabulary v ON v.id = t.id ORDER BY t.pos)
"""

# One contraction of a long piece: every occurrence of the smallest-ranked pair, leftmost first.
_LONG_STEP = """
CREATE OR REPLACE TEMP TABLE found AS
WITH neighbours AS (
    SELECT row_number() OVER w AS pos, id, lead(id) OVER w AS nxt, lead(id, 2) OVER w AS after, lag(id) OVER w AS before
    FROM long_piece WINDOW w AS (ORDER BY pos)),
ranked AS (SELECT n.*, m.merged FROM neighbours n JOIN merges m ON m.pair = (n.id::BIGINT << 32 | n.nxt)),
least AS (SELECT * FROM ranked WHERE merged = (SELECT min(merged) FROM ranked)),
runs AS (SELECT *, pos - row_number() OVER (ORDER BY pos) AS run FROM least)
SELECT * FROM (SELECT *, (pos - min(pos) OVER (PARTITION BY run)) % 2 AS turn FROM runs) WHERE turn = 0
"""
_LONG_NEW_PAIRS = """
SELECT count(*) FROM (
    SELECT merged::BIGINT << 32 | after AS pair, merged FROM found
    UNION ALL SELECT before::BIGINT << 32 | merged, merged FROM found
    UNION ALL SELECT merged::BIGINT << 32 | merged, merged FROM found) f
JOIN merges m ON m.pair = f.pair WHERE m.merged < f.merged
"""
_LONG_CONTRACT = """
CREATE OR REPLACE TEMP TABLE long_piece AS
SELECT p.pos, coalesce(f.merged, p.id) AS id
FROM (SELECT row_number() OVER (ORDER BY pos) AS pos, id FROM long_piece) p
LEFT JOIN found f ON f.pos = p.pos
WHERE p.pos NOT IN (SELECT pos + 1 FROM found)
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


# A space beside another white space character, or one that is not ASCII, keeps a text in one part.
_DOUBLE = [(c, c + " ", " " + c) for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"]
_WIDE = [c for c in map(chr, range(0x80, 0x3001)) if c.isspace()]


def _lists(units: list, flat: np.ndarray) -> pa.Table:
    """A row per unit, with its ids as a list."""
    ends = np.zeros(len(units) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, units), np.int32, len(units)), out=ends[1:])
    return pa.table({
        "piece": np.arange(len(units), dtype=np.int64), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))
    })


def _rows(units: list, flat: np.ndarray) -> pa.Table:
    lens = np.fromiter(map(len, units), np.int64, len(units))
    starts = np.cumsum(lens) - lens
    return pa.table({
        "piece": np.repeat(np.arange(len(units), dtype=np.int64), lens),
        "pos": np.arange(len(flat)) - np.repeat(starts, lens), "id": flat.astype(np.int32),
    })


def _statements(units: list[int], pieces: list) -> Iterable[list[int]]:
    """The given pieces in groups of about as many token-position rows as go into one statement."""
    start = size = 0
    for k, i in enumerate(units):
        size += len(pieces[i])
        if size >= ROWS_PER_STATEMENT:
            yield units[start : k + 1]
            start, size = k + 1, 0
    if start < len(units):
        yield units[start:]


class Codec:
    """Encoder and decoder of one worker: a DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # The Rust regular expressions of the tiktoken library mean by \s the property White_Space.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.ranks = ranks
        self.tokens = {t: rank.to_bytes(4, "little") for t, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        find = ranks.get
        pairs = [
            (head << 32 | tail, rank) for t, rank in ranks.items() for i in range(1, len(t))
            if (head := find(t[:i])) is not None and (tail := find(t[i:])) is not None
        ]
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '250MB'")
        self.db.execute("SET temp_directory = ''")  # statements are small; nothing is spilled to a worker's folder
        self._table("merges", pa.table({
            "pair": pa.array([p for p, _ in pairs], pa.int64()), "merged": pa.array([m for _, m in pairs], pa.int32())
        }))
        # A character of the text stands for a byte.
        self._table("vocabulary", pa.table({
            "id": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array([t.decode("latin-1") for t in ranks])
        }))
        self.lengths = np.zeros(max(ranks.values()) + 2, np.int64)  # bytes by id, 0 if unknown; the last entry is for larger ids
        self.lengths[list(ranks.values())] = list(map(len, ranks))
        self.pieces, self.chunks = Generations(REMEMBERED), Generations(REMEMBERED)

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("incoming", rows)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers.

        A piece that is a token stays whole, as in the tiktoken library.
        """
        out: list = [self.tokens.get(p) for p in pieces]
        todo = [i for i, ids in enumerate(out) if ids is None]
        short = [i for i in todo if len(pieces[i]) <= LONG_BYTES]
        for part in _statements(short, pieces):
            units = [pieces[i] for i in part]
            self._table("start", _lists(units, self.single[np.frombuffer(b"".join(units), np.uint8)]))
            found = self.db.sql(ENCODE).to_arrow_table().combine_chunks()
            lists = found.column("ids").chunk(0)
            ends = (lists.offsets.to_numpy() * 4).tolist()
            flat = lists.values.to_numpy().astype("<u4").tobytes()
            for k, piece in enumerate(found.column("piece").to_pylist()):
                out[part[piece]] = flat[ends[k] : ends[k + 1]]
        for i in todo:
            if out[i] is None:
                out[i] = self._encode_long(pieces[i]) if pieces[i] else b""
        return out

    def _encode_long(self, piece: bytes) -> bytes:
        """Ids of a very long piece.

        A step contracts all occurrences of the smallest-ranked pair at once if none of the pairs that come
        up on the way has a smaller rank, for then the leftmost of them would follow one after the other;
        else only the leftmost.
        """
        self._table("long_piece", _rows([piece], self.single[np.frombuffer(piece, np.uint8)]).drop(["piece"]))
        while True:
            self.db.execute(_LONG_STEP)
            if not self.db.execute("SELECT count(*) FROM found").fetchall()[0][0]:
                break
            if self.db.execute(_LONG_NEW_PAIRS).fetchall()[0][0]:
                self.db.execute("DELETE FROM found WHERE pos > (SELECT min(pos) FROM found)")
            self.db.execute(_LONG_CONTRACT)
        rows = self.db.execute("SELECT id FROM long_piece ORDER BY pos").fetchall()
        return np.array(rows, "<u4").tobytes()

    def decode_pieces(self, pieces: list[np.ndarray]) -> list[bytes]:
        """Bytes of each id sequence; an empty one gives no bytes, an unknown id is an error."""
        out = [b""] * len(pieces)
        todo = [i for i, ids in enumerate(pieces) if len(ids)]
        for part in _statements(todo, pieces):
            units = [pieces[i] for i in part]
            flat = np.concatenate(units)
            lengths = self.lengths[np.minimum(flat, len(self.lengths) - 1)]
            if not lengths.all():
                raise ValueError("an id is not in the vocabulary")
            self._table("tokens", pa.table({"pos": np.arange(len(flat)), "id": flat.astype(np.int32)}))
            text = self.db.execute(DECODE).fetchall()[0][0].encode("latin-1")
            ends = np.cumsum(lengths)[np.cumsum(np.fromiter(map(len, units), np.int64, len(units))) - 1].tolist()
            for i, a, b in zip(part, [0, *ends], ends):
                out[i] = text[a:b]
        return out

    def _chunks(self, text: str) -> list[str]:
        """Parts of a text that the pattern treats apart: cut before a single space between other characters."""
        if text[0] == " " or text[-1] == " " or "\0" in text or "  " in text:
            return [text]
        if any(c in text and (a in text or b in text) for c, a, b in _DOUBLE):
            return [text]
        if not text.isascii() and any(c in text for c in _WIDE):
            return [text]
        return text.replace(" ", "\0 ").split("\0")

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """For each text its ids, as little-endian unsigned 32-bit integers."""
        chunked = [self._chunks(t) if t else [] for t in texts]
        self._learn(set(chain.from_iterable(chunked)))
        known = self.chunks.young.__getitem__
        return [b"".join(map(known, chunks)) for chunks in chunked]

    def _learn(self, chunks: set[str]) -> None:
        """Have the ids of all these chunks among the young ones."""
        new = self.chunks.unknown(chunks)
        # Tuples of texts, unlike lists, are soon left alone by Python's garbage collector.
        found = list(map(tuple, map(self.pattern.findall, new)))
        pieces = list(self.pieces.unknown(set(chain.from_iterable(found))))
        self.pieces.young.update(zip(pieces, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in pieces])))
        known = self.pieces.young.__getitem__
        self.chunks.young.update(zip(new, [known(f[0]) if len(f) == 1 else b"".join(map(known, f)) for f in found]))

    def decode_texts(self, texts: list[bytes]) -> list[bytes]:
        """Bytes of documents given as their ids in little-endian unsigned 32-bit integers."""
        return self.decode_pieces([np.frombuffer(ids, "<u4") for ids in texts])


def codec(vocabulary: bytes, pattern: str) -> Codec:
    """A new codec. ``vocabulary`` is the content of a rank file."""
    lines = (line.split() for line in vocabulary.splitlines() if line.strip())
    return Codec({base64.b64decode(t): int(r) for t, r in lines}, pattern)


# Texts encoded together, by their length in characters.
CHARS_PER_BLOCK = 1_000_000


def blocks(texts: list[str], limit: int = CHARS_PER_BLOCK) -> Iterable[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _vocabulary(path: str) -> bytes:
    """A vocabulary file, read on the driver; it goes to the workers with the task, so its size is checked."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path} has more than 64 MiB")
    return data


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` for every row; a null or empty text has no ids. Special tokens are ordinary text."""
    data = _vocabulary(vocabulary)

    def make():
        own = codec(data, pattern)

        def run(batch: pa.RecordBatch):
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for a, b in blocks(texts):
                ids = [np.frombuffer(i, "<u4").astype(np.int32) for i in own.encode_texts(texts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"]
                )

        return run

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return by_batch(narrow, make, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, bytes binary)`` of ``(id, ids)``; null ids count as none."""
    data = _vocabulary(vocabulary)

    def make():
        own = codec(data, pattern)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [np.array(i or [], "<u4") for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own.decode_pieces(ids), pa.binary())], names=[id_col, "bytes"]
            )

        return run

    return by_batch(
        encoded.select(id_col, "ids"), make, f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, bytes binary"
    )


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: every whole text encoded, then decoded from its ids.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` over the bytes
    that the ids decode to. A null text counts as empty. Repeated rows give repeated rows.
    """
    data = _vocabulary(vocabulary)

    def make():
        own = codec(data, pattern)

        def run(batch: pa.RecordBatch):
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for a, b in blocks(texts):
                ids = own.encode_texts(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(t).hexdigest() for t in own.decode_texts(ids)]),
                    ],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

        return run

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = docs.schema[id_col].dataType.simpleString()
    return by_batch(narrow, make, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
