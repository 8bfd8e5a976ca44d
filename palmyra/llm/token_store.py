"""Token ids on disk: one zstandard frame a document, one shared dictionary.

Layout of a data set directory::

    dictionary         zstandard dictionary, trained on serialized id arrays
    *.bin              32 bytes SHA-256 of the dictionary, then the frames
    *.idx              one INDEX entry a document, in the order of the frames
    manifest/          parquet, one row a shard: what belongs to the data set

A frame holds the document's ids as little-endian unsigned integers (two bytes
while the vocabulary fits, else four). A reader refuses a shard whose dictionary
hash is not that of the dictionary beside it. With the index a single document
is one seek and one small frame (:func:`read_document`).

Documents are ranged and sorted by id before they are encoded, so the shards in
manifest order hold all ids in ascending order; each task streams its rows and
holds one batch. Cases: a null or empty text has only the end id; a null doc_id
sorts first; rows with one doc_id are all kept, ordered by text; an empty table
gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palmyra.llm import files
from palmyra.llm.common import utf8_buffers

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
LEVEL = 3
DICT_BYTES = 112 * 1024
#: The dictionary is fitted on at most so many documents, and so many
#: characters of each; every document is encoded whole.
SAMPLE_DOCS = 512
SAMPLE_CHARS = 20_000
#: Pieces that a Python worker remembers.
CACHE_PIECES = 2_000_000
#: Texts that are cut and looked up together.
RUN_BYTES = 8 << 20
#: Index entry of a document without an id: the least id, and this bit of its length.
LEAST_ID = -(1 << 63)
NO_ID = 1 << 31
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u4"), ("n_tokens", "<u4")])
MANIFEST = ("shard int, bin string, idx string, n_docs long, n_tokens long, "
            "first_doc long, last_doc long")

_encoders: dict[str, Encoder] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Known(dict):
    """Results of ``find`` by its argument; emptied when it holds too many."""

    def __init__(self, find: Callable[[bytes], bytes]):
        super().__init__()
        self.find, self.most = find, CACHE_PIECES

    def __missing__(self, key: bytes) -> bytes:
        value = self.find(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


#: Kinds of bytes, for :func:`cuts`. SURE ones begin no white space; what is neither
#: known nor SURE (control signs, most bytes of other scripts) is OTHER.
OTHER, LETTER, DIGIT, SIGN, APOSTROPHE, LEAD, SPACE, LINE = range(8)
SURE = np.isin(np.arange(8), [LETTER, DIGIT, SIGN, APOSTROPHE, LEAD])
_KIND = np.full(256, OTHER, dtype=np.uint8)
_KIND[33:127] = SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = LETTER
_KIND[48:58] = DIGIT
_KIND[39], _KIND[32], _KIND[10] = APOSTROPHE, SPACE, LINE
# White space outside ASCII begins with C2, E1, E2 or E3.
_KIND[[b for b in range(0xC4, 0xF5) if b not in (0xE1, 0xE2, 0xE3)]] = LEAD
#: By the kinds on both sides of a place: 1 is a cut, 2 is one if the byte after next is
#: SURE, 3 if the byte before the last is.
_PAIR = np.zeros((8, 8), dtype=np.uint8)
_PAIR[LETTER:APOSTROPHE, LETTER:APOSTROPHE] = 1 - np.eye(3, dtype=np.uint8)
_PAIR[LETTER:LEAD, LINE] = 1
_PAIR[:, SPACE] = 2
_PAIR[LINE, SURE] = 3
_PAIR = _PAIR.ravel()


def cuts(raw: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places at which the UTF-8 bytes of texts can be cut so that the parts, encoded one
    by one, give the ids of the whole; ``rows`` (first byte of each text, and the end) among
    them. ByteLevel's pattern ends a token between letters, digits and signs, but an
    apostrophe may begin one with letters; before a space that begins a word; and around a
    line end that stands alone."""
    n = len(raw)
    kind = np.zeros(n + 1, dtype=np.uint8)
    kind[:n] = _KIND[raw]
    latin = np.flatnonzero(raw[:-1] == 0xC3)         # U+00C0 to U+00FF
    latin = latin[(raw[latin + 1] != 0x97) & (raw[latin + 1] != 0xB7)]
    kind[latin] = kind[latin + 1] = LETTER
    first = np.zeros(n + 2, dtype=bool)
    first[rows] = True
    cut = np.zeros(n + 1, dtype=np.uint8)
    cut[1:n] = _PAIR[(kind[:n - 1] << 3) | kind[1:n]]
    at = np.flatnonzero(cut == 2)
    cut[at] = SURE[kind[at + 1]] & ~first[at + 1]    # a text may end after the space
    at = np.flatnonzero(cut == 3)
    cut[at] = SURE[kind[at - 2]] | first[at - 1]     # or begin with the line end
    return np.flatnonzero(cut.view(bool) | first[:n + 1])


class Encoder:
    """Ids of whole texts by the tokenizers library, as bytes.

    The texts of a batch are cut where a byte-level tokenizer without a prefix space ends
    a token anyway (:func:`cuts`). Arrow numbers the different pieces, each is looked up
    once a batch, pieces that came before are not encoded again, and Arrow joins their
    ids. A text with the content of an added token is encoded as it stands, and so is
    every text for another kind of tokenizer.
    """

    #: Letters, with or without a space before: one pre-token.
    LETTERS = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        if sys.byteorder != "little":
            raise RuntimeError("ids are written little-endian")
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        pre = repr(self.tokenizer.pre_tokenizer)
        self.by_piece = (pre.startswith("ByteLevel(add_prefix_space=False")
                         and "use_regex=True" in pre and self.tokenizer.normalizer is None
                         and self.tokenizer.post_processor is None)
        # The tokenizer takes these out of a text before it cuts the rest.
        self.added = tuple({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.pieces = _Known(self._piece)

        # Printable bytes stand for themselves in the model's alphabet, the others for
        # the characters from U+0100 on, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.alphabet = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(other)}
        self.space = chr(self.alphabet[32])
        self.model = self.tokenizer.model

    def raw(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        """Letters go straight to the tokenizer's model, without the passes over a text
        around it."""
        if not self.LETTERS.fullmatch(piece):
            return self.raw(piece.decode())
        letters = (piece.decode().replace(" ", self.space) if piece.isascii()
                   else piece.decode("latin-1").translate(self.alphabet))
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all(pa.array([text], pa.string())))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of every text in order; a null has none. Takes runs of rows of about
        RUN_BYTES (a longer text makes a run of its own)."""
        if not self.by_piece:
            yield from (self.raw(t.as_py() or "") for t in texts)
            return
        whole = np.zeros(len(texts), dtype=bool)
        for content in self.added:
            whole |= pc.fill_null(pc.match_substring(texts, content), False).to_numpy(zero_copy_only=False)
        off, raw = utf8_buffers(texts)
        lo, n = 0, len(texts)
        while lo < n:
            hi = int(np.searchsorted(off, off[lo] + RUN_BYTES, side="right")) - 1
            hi = min(n, max(hi, lo + 1))
            ids, ends = self._joined(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            for i in range(lo, hi):
                yield self.raw(texts[i].as_py()) if whole[i] else bytes(ids[ends[i - lo]:ends[i - lo + 1]])
            lo = hi

    def _joined(self, raw: np.ndarray, rows: np.ndarray) -> tuple[memoryview, list[int]]:
        """Ids of the rows back to back, and where each row begins and the last ends."""
        if not len(raw):
            return memoryview(b""), [0] * len(rows)
        at = cuts(raw, rows)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)]).dictionary_encode()
        keys = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = pa.array([*map(self.pieces.__getitem__, keys)], pa.large_binary())
        joined = found.take(pieces.indices)
        _, ends, ids = joined.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[joined.offset:joined.offset + len(at)]
        return memoryview(ids), ends[np.searchsorted(at, rows)].tolist()


def encoder(path: str, cache_pieces: int = CACHE_PIECES) -> Encoder:
    """One a Python worker: its pieces serve all of its tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    found = _encoders[path]
    found.pieces.most = cache_pieces
    return found


def train_dictionary(samples: list[bytes]) -> bytes:
    """zstandard dictionary of serialized id arrays; the arrays themselves where
    there are too few to train on, nothing where there are none."""
    samples = [s for s in samples if len(s) >= 8]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def _codec(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def sample_ids(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> list[bytes]:
    # Only ids are ordered, so no task sends texts that are not in the sample.
    key = F.col(id_col).cast("long")
    chosen = [r.id for r in docs.select(key.alias("id")).where(key.isNotNull())
              .orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS).collect()]
    rows = (docs.where(key.isin(chosen)).select(F.substring(F.col(text_col), 1, SAMPLE_CHARS).alias("t"))
            .limit(SAMPLE_DOCS).collect()) if chosen else []
    enc = encoder(path)
    end = np.array([end_id], dtype=enc.dtype).tobytes()
    return [enc.encode(r.t) + end for r in rows]


def write_tokens(docs: DataFrame, out: str, tokenizer: str | None = None, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text",
                 cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """Encode every document of ``docs`` into the directory ``out``; return the
    manifest. Other columns of ``docs`` are not read. ``cache_pieces``: how many
    pieces a Python worker remembers (about 200 bytes each), for speed only."""
    path = tokenizer or tokenizer_path()
    files.make_dir(out)
    dictionary = train_dictionary(sample_ids(docs, id_col, text_col, path, end_id))
    files.write_bytes(f"{out}/dictionary", dictionary)
    digest = hashlib.sha256(dictionary).digest()
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, cache_pieces)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        squeeze = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True,
                                           **_codec(files.read_bytes(f"{out}/dictionary")))
        name, sink, index, at = "", None, [], 32
        for batch in batches:
            ids = batch.column("doc_id")
            if sink is None and len(ids):
                name = files.attempt_name("shard")
                store, where = files.open_fs(f"{out}/{name}.bin")
                sink = store.open_output_stream(where)
                sink.write(digest)
            for doc, found in zip(ids.to_pylist(), enc.encode_all(batch.column("text"))):
                serialized = found + end
                frame = squeeze.compress(serialized)
                sink.write(frame)
                if len(frame) >= NO_ID:
                    raise ValueError(f"the frame of document {doc} is longer than an index entry can say")
                index.append((LEAST_ID if doc is None else doc, at,
                              len(frame) | (NO_ID if doc is None else 0),
                              len(serialized) // enc.width))
                at += len(frame)
        if sink is None:
            return
        sink.close()
        entries = np.array(index, dtype=INDEX)
        files.write_bytes(f"{out}/{name}.idx", entries.tobytes())
        shard = int(name.split("-")[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([f"{name}.bin"]), pa.array([f"{name}.idx"]),
             pa.array([len(entries)]), pa.array([int(entries["n_tokens"].sum(dtype=np.int64))]),
             pa.array([int(entries["doc_id"][0])]), pa.array([int(entries["doc_id"][-1])])],
            names=["shard", "bin", "idx", "n_docs", "n_tokens", "first_doc", "last_doc"])

    return files.commit(ordered.drop("tie").mapInArrow(write, MANIFEST), out)


def _check(raw: bytes, dictionary: bytes, name: str) -> None:
    if raw != hashlib.sha256(dictionary).digest():
        raise ValueError(f"{name}: written with another dictionary")


def _width(path: str) -> np.dtype:
    return encoder(path).dtype


def read_tokens(spark: SparkSession, out: str, tokenizer: str | None = None,
                with_ids: bool = True) -> DataFrame:
    """Every document of a data set, from its files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers), frame_bytes, dictionary_sha256 and, if asked
    for, ids."""
    dtype = _width(tokenizer or tokenizer_path())
    shards = spark.read.parquet(f"{out}/manifest").orderBy("shard").collect()
    starts = accumulate([0] + [s.n_tokens for s in shards])
    schema = ("doc_id long, start long, n_tokens long, ids_crc32 long, frame_bytes long, "
              "dictionary_sha256 string" + ", ids array<int>" * with_ids)

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dictionary = files.read_bytes(f"{out}/dictionary")
        expand = zstandard.ZstdDecompressor(**_codec(dictionary))
        for part in parts:
            for row in part.itertuples():
                entries = np.frombuffer(files.read_bytes(f"{out}/{row.idx}"), dtype=INDEX)
                store, where = files.open_fs(f"{out}/{row.bin}")
                with store.open_input_stream(where) as src:
                    _check(src.read(32), dictionary, row.bin)
                    yield from _documents(src, expand, entries, int(row.start), dtype,
                                          dictionary, with_ids)

    rows = [(s.bin, s.idx, start) for s, start in zip(shards, starts)]
    return files.spread(spark, rows, "bin string, idx string, start long").mapInPandas(read, schema)


def _documents(src, expand, entries: np.ndarray, start: int, dtype: np.dtype, dictionary: bytes,
               with_ids: bool, step: int = 500) -> Iterator[pd.DataFrame]:
    sha = hashlib.sha256(dictionary).hexdigest()
    for lo in range(0, len(entries), step):
        part = entries[lo:lo + step]
        crcs, ids = [], []
        lengths = part["length"] & np.uint32(NO_ID - 1)
        for length, n in zip(lengths.tolist(), part["n_tokens"].tolist()):
            values = np.frombuffer(expand.decompress(src.read(length)), dtype=dtype)
            if len(values) != n:
                raise ValueError("a frame and its index entry differ in length")
            wide = values.astype("<u4")
            crcs.append(zlib.crc32(wide.tobytes()))
            ids.append(wide.astype(np.int32))
        counts = part["n_tokens"].astype(np.int64)
        doc = pd.Series(part["doc_id"].astype(object)).where(part["length"] < NO_ID, None)
        out = {"doc_id": doc.astype("Int64"), "start": start + np.cumsum(counts) - counts,
               "n_tokens": counts, "ids_crc32": np.array(crcs, dtype=np.int64),
               "frame_bytes": lengths.astype(np.int64), "dictionary_sha256": sha}
        if with_ids:
            out["ids"] = ids
        start += int(counts.sum())
        yield pd.DataFrame(out)


def read_document(spark: SparkSession, out: str, doc_id: int,
                  tokenizer: str | None = None) -> list[list[int]]:
    """Ids of the documents with this id: reads the manifest, the index of the
    shards whose range holds it, and only its frames."""
    dtype = _width(tokenizer or tokenizer_path())
    dictionary = files.read_bytes(f"{out}/dictionary")
    expand = zstandard.ZstdDecompressor(**_codec(dictionary))
    found = []
    near = (spark.read.parquet(f"{out}/manifest")
            .where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
            .orderBy("shard").collect())
    for s in near:
        entries = np.frombuffer(files.read_bytes(f"{out}/{s.idx}"), dtype=INDEX)
        store, where = files.open_fs(f"{out}/{s.bin}")
        with store.open_input_file(where) as src:
            _check(src.read_at(32, 0), dictionary, s.bin)
            for e in _entries_of(entries, doc_id):
                frame = src.read_at(int(e["length"]), int(e["offset"]))
                found.append(np.frombuffer(expand.decompress(frame), dtype=dtype).tolist())
    return found


def _entries_of(entries: np.ndarray, doc_id: int) -> Iterable[np.void]:
    a = np.searchsorted(entries["doc_id"], doc_id)
    b = np.searchsorted(entries["doc_id"], doc_id, side="right")
    return [e for e in entries[a:b] if e["length"] < NO_ID]
