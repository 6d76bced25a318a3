import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

import edge
from kinweave.llm import byte_bpe, token_files
from kinweave.llm.common import Generations

RANKS = P.path("byte_bpe_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
ODD = ["a", "É", "é", " ", "\n", "\t", "'s", "'", "́", "1", "#", "\x1c", "\x85", "İ", "ſ", "Σ", "<|endoftext|>", "日", "　", "\xa0", "the", "\0", "😀"]


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return byte_bpe.codec(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_encodes_like_the_library_and_decodes_to_the_text(codec, reference):
    rnd = random.Random(1)
    texts = ["", " ", "a\n\n b  c ", "word " * 50, "aaaa " + "a" * 1_500, "ab" * 1_200, "".join(rnd.choice("etaoin") for _ in range(1_500))]
    texts += ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    found = codec.encode_texts(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), text[:60]
    assert codec.decode_texts(found) == [t.encode() for t in texts]
    with pytest.raises(ValueError):
        codec.decode_pieces([np.array([999_999], "<u4")])


def test_remembered_pieces_do_not_change_ids(codec, reference):
    text = "Some thhahe worrds thhahe, again thhahe"
    codec.pieces.size = codec.chunks.size = 2
    for _ in range(4):
        assert np.frombuffer(codec.encode_texts([text])[0], "<u4").tolist() == reference.encode_ordinary(text)
    codec.pieces.size = codec.chunks.size = byte_bpe.REMEMBERED


def test_round_trip_of_awkward_rows(spark, reference):
    docs = edge.documents(spark)
    found = sorted(map(tuple, byte_bpe.round_trip(docs, RANKS, P.PATTERN).collect()), key=str)
    want = []
    for doc_id, text, *_ in edge.rows():
        ids = reference.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(want, key=str)
    assert byte_bpe.round_trip(edge.empty(spark), RANKS, P.PATTERN).count() == 0
    encoded = byte_bpe.encode(docs, RANKS, P.PATTERN)
    decoded = sorted((r.doc_id or 0, bytes(r.bytes)) for r in byte_bpe.decode(encoded, RANKS, P.PATTERN).collect())
    assert decoded == sorted((r[0] or 0, (r[1] or "").encode()) for r in edge.rows())


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 8_191, 8_192, 8_193, 20_000])
def test_planes_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 49_408, n).astype("<u4")
    assert (token_files.unpack(token_files.pack(ids, 16)) == ids).all()
    planes = token_files.to_planes(ids, 16, 8_192)
    assert all(len(p) == sum((min(8_192, n - i) + 7) // 8 for i in range(0, n, 8_192)) for p in planes)
    if n > 1:
        assert planes[3][0] & 1 == ids[0] >> 3 & 1
    with pytest.raises(ValueError):
        token_files.pack(np.array([1 << 16]), 16)


def test_words_are_encoded_as_in_the_whole_text():
    reference = Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as f:
        own = token_files.WordEncoder(f.read())
    rnd = random.Random(2)
    special = ["<|startoftext|>", "<|endoftext|>", "<|EndOfText|>", "a<|endoftext|>.", "<|", "|>", "hi <|endoftext|> yo", "\x1c", "\xa0", "\u2028"]
    texts = ["".join(rnd.choice([*ODD, *special, "\x0b", "\r"]) for _ in range(rnd.randint(0, 60))) for _ in range(600)]
    texts += [None, "", " ", *special]
    ids, lengths = own(pa.array(texts))
    for text, found in zip(texts, np.split(ids, np.cumsum(lengths))):
        assert found.tolist() == reference.encode(text or "", add_special_tokens=False).ids, repr(text)
    assert own.one("hi <|endoftext|> yo") == [1883, 49407, 3497]


def test_other_tokenizers_are_refused():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        token_files.WordEncoder(f.read())


def test_files_hold_every_document_in_order(spark, tmp_path):
    reference = Tokenizer.from_file(WORDS)
    more = [(50, "hi <|endoftext|> yo <|STARTOFTEXT|>", "en", "s", 1), (51, "<|startoftext|>,", "en", "s", 1)]
    rows = edge.rows() + more + [(None, f"null id {i}", "en", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(3)
    token_files.write(docs, str(tmp_path), WORDS, 2, 16, chunk=500)
    found = sorted(token_files.read(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    start, texts = 0, {}
    for doc_id, text, *_ in rows:
        texts.setdefault(doc_id, []).append([*reference.encode(text or "", add_special_tokens=False).ids, 2])
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.start == start and r.n_tokens == len(ids)
        texts[r.doc_id].remove(ids)
        start += len(ids)
    assert not any(texts.values())
    index = spark.read.parquet(f"{tmp_path}/index")
    assert index.count() > 3 and index.agg({"n_ids": "sum", "n_docs": "sum"}).first()["sum(n_docs)"] == len(found)
    sums = {(r.start, r.ids_crc32) for r in token_files.checksums(spark, str(tmp_path)).collect()}
    assert sums == {(r.start, zlib.crc32(bytes(r.ids))) for r in found}
    assert token_files.write_and_check(edge.empty(spark), WORDS, 2, 16).count() == 0


def test_codec_goes_with_its_task(spark):
    def left(batches):
        import gc

        from kinweave.llm.byte_bpe import Codec

        for batch in batches:
            n = sum(isinstance(o, Codec) for o in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], names=["n"])

    rows = spark.range(64).repartition(8)
    docs = rows.selectExpr("id AS doc_id", "concat('thhahe ', id) AS text")
    assert byte_bpe.round_trip(docs, RANKS, P.PATTERN).agg({"n_tokens": "count"}).first()[0] == 64
    assert rows.mapInArrow(left, "n long").agg({"n": "max"}).first()[0] == 0


def test_long_texts_end_a_generation_of_the_cache():
    kept = Generations(10)
    for i in range(100):
        kept.young.update((k, b"") for k in kept.unknown({f"{i} " * 400}))
        assert sum(map(len, [*kept.young, *kept.old])) < 64 * 10 + 2_000
    few = Generations(10)
    few.young.update((k, b"1") for k in few.unknown({"a", "b"}))
    few.length = 640
    assert few.unknown({"b", "c"}) == {"c"} and few.young == {"b": b"1"} and few.old == {"a": b"1", "b": b"1"}


def test_decoding_sorts_no_groups(codec):
    assert "GROUP BY" not in byte_bpe.DECODE
    texts = ["", "a", "", "Ünï\x00 \x80 日本 " * 30, "b" * 300]
    assert codec.decode_texts(codec.encode_texts(texts)) == [t.encode() for t in texts]
    assert codec.decode_pieces([np.array([], "<u4")] * 2) == [b"", b""]
