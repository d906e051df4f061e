import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs as pafs

from tessella.llm import token_store as S
from tessella.llm import wfst
from tessella.llm.queries import tokenizer_path

from .helpers import empty_docs, odd_docs

PIECES = ["a", "foo", "é", "日本", "1", "22", "'s", "'", "-", "|", " ", " ", "\n", "\t", "\r\n", " ", "　", "\x85", "\x1c", "\0", "<|endoftext|>", "<s>", "😀", "_", "▁", ".", ",", "the "]


def texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def spm():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def model_proto():
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    return proto


def test_bpe_encoding_equals_the_library(spm, sf):
    import duckdb

    values = texts(2000, 1) + [r[0] for r in duckdb.sql(f"select text from '{sf}/documents.parquet'").fetchall()]
    model = wfst.Model.load(tokenizer_path("piece_bpe_32k.model"))
    want = spm.encode(values)
    assert [model.encode(v).tolist() for v in values] == want
    ids, offsets = model.encode_batch(values)
    assert [ids[a:z].tolist() for a, z in zip(offsets, offsets[1:])] == want
    assert [model.decode(np.array(w, np.int32)) for w in want] == spm.decode(want)
    assert [x.decode("utf-8", "replace") for x in model.decode_batch(ids, offsets)] == spm.decode(want)


def test_unigram_encoding_equals_the_library():
    import sentencepiece

    proto = model_proto()
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        p.score = max(p.score, -40000.0)
    values = [v.replace("\0", "") for v in texts(300, 2)]
    library, model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), wfst.Model(proto.SerializeToString())
    assert [model.encode(v).tolist() for v in values] == library.encode(values)
    proto.trainer_spec.byte_fallback = False  # neighbouring unknown characters become one piece
    for p in proto.pieces:
        p.type = 1 if p.type == 6 else p.type
    library, model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), wfst.Model(proto.SerializeToString())
    assert [model.encode(v).tolist() for v in values[:100]] == library.encode(values[:100])


@pytest.mark.parametrize("squeeze,prefix", [(True, True), (True, False), (False, False)])
def test_normaliser_settings(squeeze, prefix):
    import sentencepiece

    proto = model_proto()
    proto.normalizer_spec.remove_extra_whitespaces, proto.normalizer_spec.add_dummy_prefix = squeeze, prefix
    library, model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), wfst.Model(proto.SerializeToString())
    values = ["  a  b ", "a", "", "   ", "x   y\n z", " lead"]
    assert [model.encode(v).tolist() for v in values] == library.encode(values)


def test_decoding_bytes_and_control():
    model = wfst.Model.load(tokenizer_path("piece_bpe_32k.model"))
    assert model.decode(np.array([model.byte[0xC3], model.byte[0xA9]])) == "é" and model.decode(np.array([model.byte[0xC3]])) == "�"
    assert model.decode(np.array([1, 2])) == "" and model.decode(np.zeros(0, np.int32)) == ""
    with pytest.raises(ValueError):
        model.decode(np.array([99_999]))


def test_operator_on_odd_rows(spark, spm):
    path = tokenizer_path("piece_bpe_32k.model")
    docs = odd_docs(spark)
    got = wfst.encode_documents(docs, path).collect()
    assert len(got) == docs.count()
    assert sorted((r["doc_id"] or -1, r["ids"], r["decoded"]) for r in got) == sorted((d["doc_id"] or -1, spm.encode(d["text"] or ""), d["text"] or "") for d in docs.collect())
    digest = {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in wfst.encode_digests(docs, path).collect()}
    assert digest == {(r["doc_id"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got}
    assert all(r["exact"] for r in wfst.encode_digests(docs, path).collect())
    assert wfst.encode_digests(empty_docs(spark), path).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_packing_round_trip(bits, values):
    ids = np.array(values, np.uint64) & np.uint64((1 << bits) - 1)
    assert S.unpack(S.pack(ids.astype(np.uint32), bits), len(ids), bits).tolist() == ids.tolist()
    assert len(S.pack(ids.astype(np.uint32), bits)) == -(-len(ids) * bits // 8)


def test_minimum_bits():
    assert [S.bits_for(v) for v in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize("bits", [5, 16])
def test_shard_random_access(tmp_path, bits):
    rnd = np.random.default_rng(5)
    store, path = pafs.LocalFileSystem(), str(tmp_path / "a.bits")
    rows = [(None, rnd.integers(0, 32, 7))] + [(k, rnd.integers(0, 32, int(rnd.integers(0, 40)))) for k in range(50)]
    writer = S.ShardWriter(store, path, bits, block_ids=16)
    for d, ids in rows:
        writer.add(d, ids.astype(np.uint32))
    assert writer.close()[1:] == (51, sum(len(x) for _, x in rows))
    reader, flat = S.ShardReader(store, path), np.concatenate([x for _, x in rows])
    assert [(d, x.tolist()) for d, _, x in reader.documents(span=30)] == [(d, x.tolist()) for d, x in rows]
    for a, z in ((0, 1), (15, 17), (16, 32), (5, 5), (3, len(flat))):
        assert reader.range(a, z).tolist() == flat[a:z].tolist()
    assert [p.name for p in tmp_path.iterdir()] == ["a.bits"]


def test_units_equal_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    values = texts(4000, 3)
    ids, offsets = S.UnitEncoder(tokenizer_path("byte_bpe_50k.json"))(pa.array(values))
    want = [e.ids + [0] for e in library.encode_batch(values, add_special_tokens=False)]
    assert [ids[a:z].tolist() for a, z in zip(offsets, offsets[1:])] == want


def test_added_tokens_are_taken_as_the_library_takes_them(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    values = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y. <|endoftext|", " <|endoftext|><|endoftext|> \n", "plain text, no token", "a <|endoftext|>\nb"]
    ids, offsets = S.UnitEncoder(tokenizer_path("byte_bpe_50k.json"))(pa.array(values))
    assert [ids[a:z].tolist() for a, z in zip(offsets, offsets[1:])] == [library.encode(x, add_special_tokens=False).ids + [0] for x in values]
    assert ids[offsets[0] : offsets[1]].tolist() == [64, 220, 50256, 275, 0]
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    got = S.read_tokens(S.write_tokens(docs, tokenizer_path("byte_bpe_50k.json"))).collect()
    assert sorted(map(tuple, got)) == expected(docs)


def expected(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    start, out = 0, []
    for d in sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "")):
        ids = np.array(library.encode(d["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [S.SHARD_IDS, 50])
def test_store_round_trip(spark, shard_ids):
    docs = odd_docs(spark, texts(60, 4))
    manifest = S.write_tokens(docs, tokenizer_path("byte_bpe_50k.json"), block_ids=64, shard_ids=shard_ids)
    got = sorted((tuple(r) for r in S.read_tokens(manifest).collect()), key=lambda r: r[1])
    assert got == expected(docs)
    empty = S.write_tokens(empty_docs(spark), tokenizer_path("byte_bpe_50k.json"))
    assert S.read_tokens(empty).collect() == []
