import random
import zlib

import numpy as np
import pytest

from palmyra.llm import files, token_store
from palmyra.sources.writers import scratch_path

ROWS = [(4, "Hello, world. This is  a test\n\nof <|endoftext|> spaces "), (1, None), (2, ""),
        (2, "same id"), (7, "naïve café, straße\tünd 日本語 😀"), (9, " lead"), (None, "no id"),
        (12, "word " * 30_000), (13, "a b c  d"), (4, "It's they're o'clock 12.5% x_y")]


@pytest.fixture(scope="module")
def store(spark):
    from palmyra.llm.common import prepare_workers
    prepare_workers(spark)
    docs = spark.createDataFrame([(i, t, "n") for i, t in ROWS], "doc_id long, text string, shard string")
    out = scratch_path(spark, "test-tokens")
    token_store.write_tokens(docs, out)
    return out


def expected():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_store.tokenizer_path())
    return [(i, t.encode(x or "", add_special_tokens=False).ids + [2]) for i, x in ROWS]


def test_round_trip_of_every_document(spark, store):
    got = sorted((str(r.doc_id), list(r.ids)) for r in token_store.read_tokens(spark, store).collect())
    assert got == sorted((str(i), ids) for i, ids in expected())


def test_starts_and_checksums(spark, store):
    rows = token_store.read_tokens(spark, store).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        at += r.n_tokens


def test_one_document_by_its_index(spark, store):
    want = expected()
    assert token_store.read_document(spark, store, 7) == [dict(want)[7]]
    assert sorted(token_store.read_document(spark, store, 4)) == sorted(v for i, v in want if i == 4)
    assert token_store.read_document(spark, store, 5) == []


def test_the_least_id_is_no_missing_one(spark):
    docs = spark.createDataFrame([(None, "none"), (-2**63, "least"), (2**63 - 1, "most")], "doc_id long, text string")
    out = scratch_path(spark, "test-tokens-ids")
    token_store.write_tokens(docs, out)
    assert [r.doc_id for r in token_store.read_tokens(spark, out).orderBy("start").collect()] == [
        None, -2**63, 2**63 - 1]
    assert len(token_store.read_document(spark, out, -2**63)) == 1
    assert len(token_store.read_document(spark, out, 2**63 - 1)) == 1


def test_another_dictionary_is_refused(spark, store):
    files.write_bytes(f"{store}/dictionary.bak", files.read_bytes(f"{store}/dictionary"))
    files.write_bytes(f"{store}/dictionary", b"")
    with pytest.raises(Exception, match="another dictionary"):
        token_store.read_document(spark, store, 7)
    files.write_bytes(f"{store}/dictionary", files.read_bytes(f"{store}/dictionary.bak"))


def test_empty_table(spark):
    out = scratch_path(spark, "test-tokens")
    token_store.write_tokens(spark.createDataFrame([], "doc_id long, text string"), out)
    assert token_store.read_tokens(spark, out).count() == 0


def test_file_that_no_manifest_names_is_not_read(spark, store):
    n = token_store.read_tokens(spark, store).count()
    files.write_bytes(f"{store}/shard-000000-stray.bin", b"x" * 100)
    assert token_store.read_tokens(spark, store).count() == n


def test_pieces_give_the_ids_of_whole_texts(sf0001):
    import pyarrow.parquet as pq
    enc = token_store.encoder(token_store.tokenizer_path())
    assert enc.by_piece
    for text in pq.read_table(f"{sf0001}/documents.parquet", columns=["text"])["text"].to_pylist():
        assert enc.encode(text) == enc.raw(text)


def test_pieces_of_odd_texts():
    rng = random.Random(3)
    enc = token_store.encoder(token_store.tokenizer_path())
    for _ in range(5000):
        text = "".join(rng.choices("aB's.,#!\n \té1_-$%\"’ ll re", k=rng.randrange(1, 25)))
        assert enc.encode(text) == enc.raw(text), text


@pytest.mark.parametrize("text", ["one <|endoftext|> two", "x<|endoftext|>y", "<|endoftext|>",
                                  "a <|endoftext| > b<|endoftext|>"])
def test_pieces_keep_added_tokens(text):
    enc = token_store.encoder(token_store.tokenizer_path())
    assert enc.encode(text) == enc.raw(text)


def test_pieces_of_a_batch_give_the_ids_of_whole_texts():
    import pyarrow as pa
    rng = random.Random(5)
    enc = token_store.encoder(token_store.tokenizer_path())
    texts = [None, "", " ", "\n", "a \n", "<|endoftext|> x"] + ["".join(rng.choices(
        "aB's.,#!\n \t\r\x1cé1_-$%\"’×÷  　\u0085日Дя́ß²😀", k=rng.randrange(25))) for _ in range(20_000)]
    for part in (pa.array(texts), pa.array(["x y", *texts]).slice(1)):
        assert list(enc.encode_all(part)) == [enc.raw(t) if t else b"" for t in texts]


def test_long_batches_are_cut_in_runs(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(token_store, "RUN_BYTES", 30)
    enc = token_store.encoder(token_store.tokenizer_path())
    texts = ["one two.", "", "three " * 20, None, "é 日 four\nfive", "six"] * 3
    assert list(enc.encode_all(pa.array(texts))) == [enc.raw(t) if t else b"" for t in texts]


def test_a_word_is_encoded_once_whatever_follows_it():
    """Words times signs made as many pieces, each of them looked up wherever it came."""
    enc = token_store.Encoder(token_store.tokenizer_path())
    asked, find = [], enc.pieces.find
    enc.pieces.find = lambda piece: asked.append(piece) or find(piece)
    words = [a + b + c for a in "klmn" for b in "aeiou" for c in "prst"]
    text = " ".join(w + s for w in words for s in (".", ",", "!", ";", ")", "$$$", ".\nAs", "")) * 2
    assert enc.encode(text) == enc.raw(text)
    assert len(asked) < 2 * len(words) + 20
