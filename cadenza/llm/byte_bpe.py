"""Byte-level BPE through a sentencepiece model that is written from a rank file.

Bytes are mapped one to one to printable characters; each vocabulary entry becomes a piece of these characters
with its negative rank as its score, so that sentencepiece's best-scored merge is the lowest-ranked one. The model
is serialised here, with an identity normaliser. Encoding cuts a text into pre-tokens and encodes each by itself
(an entry of the vocabulary is taken whole); decoding maps ids back to bytes. Each worker keeps the ids of
pre-tokens that it has met, up to CACHE entries. The vocabulary is read from the path on each executor's machine.

Nulls and edges: a null text is encoded as an empty one (no ids, empty decoding); null ids decode to null; texts of
any length are encoded whole; repeated rows are each encoded; result columns replace input columns of the same
name; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm._shared import ship

CACHE = 400_000
#: Longer pre-tokens are encoded without being kept.
CACHED_CHARS = 64


def byte_characters() -> list[str]:
    """A printable character for each byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in prints else next(rest)) for b in range(256)]


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: varint, 32-bit float or length-delimited, by the value's type."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file in the order of their ranks, which must run from 0."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    entries = sorted(ranks, key=ranks.__getitem__)
    if [ranks[x] for x in entries] != list(range(len(entries))):
        raise ValueError(f"{path}: ranks are not 0 to {len(entries) - 1}")
    return entries


def model_bytes(entries: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model; piece 0 is the unknown piece, entry r is piece r + 1."""
    chars = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, _field(1, "⁇".encode()) + _field(2, 0.0) + _field(3, unknown))]
    pieces += [_field(1, _field(1, "".join(chars[b] for b in x).encode()) + _field(2, float(-r)) + _field(3, normal)) for r, x in enumerate(entries)]
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, 0) + b"".join(_varint(n << 3) + _varint((1 << 64) - 1) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one rank file; ids are the ranks, held as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        self.entries = read_ranks(path)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.entries))
        # white space as the Unicode property, which leaves out the separators 1C to 1F that Python's \s holds
        self.cut = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.chars = {b: c for b, c in enumerate(byte_characters())}
        self.whole = {x: struct.pack("<I", r) for r, x in enumerate(self.entries)}
        self.known = _Known(self)

    def piece(self, pre_token: str) -> bytes:
        raw = pre_token.encode()
        if raw in self.whole:
            return self.whole[raw]
        ids = self.pieces.encode(raw.decode("latin-1").translate(self.chars), out_type=int)
        return (np.array(ids, "<u4") - np.uint32(1)).tobytes()

    def encode(self, text: str) -> bytes:
        if len(self.known) > CACHE:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, self.cut.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.entries.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Known(dict):
    def __init__(self, codec: Codec) -> None:
        self.codec = codec

    def __missing__(self, pre_token: str) -> bytes:
        ids = self.codec.piece(pre_token)
        if len(pre_token) <= CACHED_CHARS:
            self[pre_token] = ids
        return ids


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


#: Rows of a batch that is passed on; bounds what a worker holds besides its longest text.
STEP_BYTES = 4 << 20


def _mapped(column: str, outputs: list[str], of):
    """mapInArrow function that appends outputs = of(value) for a column, in batches of about STEP_BYTES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = of()
        for batch in batches:
            at = batch.schema.get_field_index(column)
            rest = [k for k, x in enumerate(batch.schema) if x.name not in outputs]
            i = 0
            while i < batch.num_rows:
                got, size, start = [], 0, i
                while i < batch.num_rows and size < STEP_BYTES:
                    got.append(f(batch.column(at)[i].as_py()))
                    size += sum(len(x) for x in got[-1] if isinstance(x, bytes))
                    i += 1
                part = batch.slice(start, i - start)
                made = [pa.array(x, pa.binary() if o in ("ids", "decoded") else pa.int64()) for o, x in zip(outputs, zip(*got, strict=True), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in rest), *made], names=[*(batch.schema[k].name for k in rest), *outputs])

    return run


def _with(df: DataFrame, column: str, outputs: dict[str, T.DataType], of) -> DataFrame:
    ship(df.sparkSession)
    schema = T.StructType([*(f for f in df.schema.fields if f.name not in outputs), *(T.StructField(k, v) for k, v in outputs.items())])
    return df.mapInArrow(_mapped(column, list(outputs), of), schema)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with ids (binary: little-endian unsigned 32-bit) and n_tokens."""

    def of():
        c = codec(path, pattern)

        def one(text: str | None) -> tuple[bytes, int]:
            ids = c.encode(text or "")
            return ids, len(ids) // 4

        return one

    return _with(docs, text_col, {"ids": T.BinaryType(), "n_tokens": T.LongType()}, of)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with ids, n_tokens and decoded, in one pass: what encode and then decode give."""

    def of():
        c = codec(path, pattern)

        def one(text: str | None) -> tuple[bytes, int, bytes]:
            ids = c.encode(text or "")
            return ids, len(ids) // 4, c.decode(ids)

        return one

    return _with(docs, text_col, {"ids": T.BinaryType(), "n_tokens": T.LongType(), "decoded": T.BinaryType()}, of)


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """rows with decoded, the bytes of the text that the ids stand for."""

    def of():
        c = codec(path, pattern)
        return lambda ids: (None if ids is None else c.decode(ids),)

    return _with(rows, ids_col, {"decoded": T.BinaryType()}, of)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    back = round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path, pattern)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
ORACLES: dict[str, str] = {}
