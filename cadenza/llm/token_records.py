"""Token ids as length-delimited binary records with a separate offset index.

A record file is a run of records: 8-byte length, masked CRC-32C of the length, payload, masked CRC-32C of the
payload (all little-endian). A payload holds one flag byte (width of an id: 2 or 4; plus 128 if the document has no
id), the 8-byte document id and the token ids. The index beside it has one 24-byte entry for each record: document
id, offset of the record, number of ids; a reader takes records in any order from it. Documents are dealt by ranges
of ids, each range is sorted and becomes one file; a file has a name of its own for each attempt, and only those of
successful attempts are in the manifest, so that a lost executor or a repeated task does no harm. The manifest is a
table of a row for each file. Files lie in the folder that driver and executors share.

Nulls and edges: a null text is an empty one, so only the end id is written; null ids come first; equal ids are in
the order of a hash of their text, and rows that repeat are all written, in several files if there are many; texts of any length are one record each; an empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import array
import json
import re
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.llm._shared import Scratch, ship
from cadenza.llm.byte_bpe import byte_characters

INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("n_tokens", "<u8")])
#: Documents of a file, and the least of one while there are fewer files than tasks.
ROWS_PER_FILE, LEAST_ROWS = 65_536, 1024
LANE = 256


def _crc_tables() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0x82F63B78), t >> 1)
    tables = [t]
    for _ in range(3):
        tables.append(t[tables[-1] & 255] ^ (tables[-1] >> 8))
    return np.array(tables)


_CRC = _crc_tables()


def _word_step(crc: np.ndarray, word: np.ndarray | int) -> np.ndarray:
    x = crc ^ word
    return _CRC[3][x & 255] ^ _CRC[2][x >> 8 & 255] ^ _CRC[1][x >> 16 & 255] ^ _CRC[0][x >> 24]


def _lane_shift() -> np.ndarray:
    """Tables that carry a checksum over LANE more zero bytes, by its four bytes."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(LANE // 4):
        bits = _word_step(bits, np.uint32(0))
    out = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for b in range(8):
            out[k][(np.arange(256) >> b & 1).astype(bool)] ^= bits[8 * k + b]
    return out


_SHIFT = _lane_shift()


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each byte string of at least 4 bytes. All are cut into lanes that advance together, then are joined."""
    sizes = np.array([len(x) for x in parts], np.int64)
    lanes = -(-sizes // LANE)
    first = np.concatenate([[0], np.cumsum(lanes)])
    buf = np.zeros(int(first[-1]) * LANE, np.uint8)
    for x, end in zip(parts, first[1:] * LANE, strict=True):  # zeros in front change nothing before the initial value
        at = int(end) - len(x)
        buf[at : at + len(x)] = np.frombuffer(x, np.uint8)
        buf[at : at + 4] ^= 255
    columns = np.ascontiguousarray(buf.view("<u4").reshape(-1, LANE // 4).T)
    crc = np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        crc = _word_step(crc, column)
    order = np.argsort(-lanes, kind="stable")
    total, counts = np.zeros(len(parts), np.uint32), lanes[order]
    for k in range(int(lanes.max(initial=0))):
        own = order[: np.searchsorted(-counts, -k, "left")]  # those with more than k lanes
        x = total[own]
        total[own] = _SHIFT[0][x & 255] ^ _SHIFT[1][x >> 8 & 255] ^ _SHIFT[2][x >> 16 & 255] ^ _SHIFT[3][x >> 24] ^ crc[first[own] + k]
    return total ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frames(payloads: list[bytes]) -> list[bytes]:
    """Payloads as records."""
    heads = [len(x).to_bytes(8, "little") for x in payloads]
    head_crc, crc = masked(crc32c(heads)).astype("<u4").tobytes(), masked(crc32c(payloads)).astype("<u4").tobytes()
    return [b"".join((h, head_crc[4 * i : 4 * i + 4], x, crc[4 * i : 4 * i + 4])) for i, (h, x) in enumerate(zip(heads, payloads, strict=True))]


def unframed(records: list[bytes]) -> list[bytes]:
    """Payloads of records; a wrong length or checksum is an error."""
    payloads = [x[12:-4] for x in records]
    if records:
        if any(int.from_bytes(x[:8], "little") != len(p) for x, p in zip(records, payloads, strict=True)):
            raise ValueError("a record's length doesn't fit its frame")
        stored = np.frombuffer(b"".join(x[8:12] + x[-4:] for x in records), "<u4")
        if (stored[0::2] != masked(crc32c([x[:8] for x in records]))).any() or (stored[1::2] != masked(crc32c(payloads))).any():
            raise ValueError("a record's checksum is wrong")
    return payloads


def payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return bytes([width | (128 if doc_id is None else 0)]) + (doc_id or 0).to_bytes(8, "little", signed=True) + ids


def parsed(x: bytes) -> tuple[int | None, bytes]:
    """Document id and ids as little-endian unsigned 32-bit integers."""
    doc_id = None if x[0] & 128 else int.from_bytes(x[1:9], "little", signed=True)
    return doc_id, x[9:] if x[0] & 127 == 4 else np.frombuffer(x, "<u2", offset=9).astype("<u4").tobytes()


def read_records(data_path: str, index_path: str, order: np.ndarray | None = None, step: int = 512) -> Iterator[list[bytes]]:
    """Payloads of one file in the order of these index places (all in file order if None), some at a time."""
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(index_path)
    with store.open_input_stream(at) as f:
        index = np.frombuffer(f.read(), INDEX)
    store, at = fs.FileSystem.from_uri(data_path)
    with store.open_input_file(at) as f:
        ends = np.append(index["offset"][1:], f.size()).astype(np.int64)
        order = np.arange(len(index)) if order is None else order
        for i in range(0, len(order), step):
            got = []
            for k in order[i : i + step]:
                f.seek(int(index["offset"][k]))
                got.append(f.read(int(ends[k]) - int(index["offset"][k])))
            yield unframed(got)


# The steps before the model in the tokenizer files that WordCache may stand in for.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def by_chunks(path: str) -> bool:
    """Whether a tokenizer's ids of a text are those of its chunks between spaces: known steps, a model without state, no added token with a space."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    plain = all(not re.search(r"\s", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in found["added_tokens"])
    return plain and found["normalizer"] == NORMALIZER and found["pre_tokenizer"] == PRE_TOKENIZER and found["model"]["type"] == "BPE" and not found["model"].get("dropout")


class Whole:
    """Ids of whole texts, for a tokenizer of any kind."""

    def __init__(self, path: str, width: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), f"<u{width}"

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.kind).tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class WordCache(dict):
    """Ids of the chunks between spaces, for tokenizers of which by_chunks holds: they drop white space, and no token spans it.

    The common chunk, letters of Latin-1 and then ASCII punctuation, is two pre-tokens whose normal form is their lower
    case; the library's model encodes them directly, once each. Every other chunk goes through the whole tokenizer.
    """

    MOST, MOST_PARTS, MOST_CHARS = 400_000, 600_000, 48

    def __init__(self, path: str, width: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.kind, self.code = Tokenizer.from_file(path), f"<u{width}", {2: "H", 4: "I"}[width]
        self.model = self.tokenizer.model
        self.simple = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([!-&(-/:-@\[-`{-~]*)").fullmatch
        self.mapped = {c: "".join(map(byte_characters().__getitem__, chr(c).encode())) for c in range(33, 256)}
        self.parts: dict[str, bytes] = {"": b""}

    def __missing__(self, chunk: str) -> bytes:
        if found := self.simple(chunk):
            letters, marks = found.groups()
            ids = (self._part(letters.lower()) if letters else b"") + self._part(marks)
        else:
            ids = self._packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        if len(chunk) <= self.MOST_CHARS:
            self[chunk] = ids
        return ids

    def _packed(self, ids: list[int]) -> bytes:
        packed = array.array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _part(self, piece: str) -> bytes:
        ids = self.parts.get(piece)
        if ids is None:
            ids = self._packed([t.id for t in self.model.tokenize(piece if piece.isascii() else piece.translate(self.mapped))])
            if len(piece) <= self.MOST_CHARS:
                self.parts[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if len(self) > self.MOST:
            self.clear()
        if len(self.parts) > self.MOST_PARTS:
            self.parts = {"": b""}
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return list(map(self.encode, texts))


_caches: dict[tuple[str, int], Whole | WordCache] = {}


def _writer(root: str, tokenizer: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        if (tokenizer, width) not in _caches:
            _caches[tokenizer, width] = (WordCache if by_chunks(tokenizer) else Whole)(tokenizer, width)
        cache = _caches[tokenizer, width]
        end = np.array([end_id], cache.kind).tobytes()
        name = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}"
        store, at = fs.FileSystem.from_uri(name)
        store.create_dir(at.rpartition("/")[0], recursive=True)
        offset, tokens, index = 0, 0, []
        with store.open_output_stream(f"{at}.rec") as out:
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    part = batch.slice(i, 256)
                    ids = [x + end for x in cache.encode_all([x or "" for x in part.column(1).to_pylist()])]
                    keys = part.column(0).to_pylist()
                    for key, x, record in zip(keys, ids, frames([payload(k, x, width) for k, x in zip(keys, ids, strict=True)]), strict=True):
                        index.append((key or 0, offset, len(x) // width))
                        tokens += len(x) // width
                        offset += len(record)
                        out.write(record)
        with store.open_output_stream(f"{at}.idx") as out:
            out.write(np.array(index, INDEX).tobytes())
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "data": [f"{name}.rec"], "index": [f"{name}.idx"], "n_rows": [len(index)], "n_tokens": [tokens]}, pa.schema([("part", pa.int32()), ("data", pa.string()), ("index", pa.string()), ("n_rows", pa.int64()), ("n_tokens", pa.int64())]))

    return run


MANIFEST = "part int, data string, index string, n_rows long, n_tokens long"


def file_count(rows: int, tasks: int) -> int:
    """Files for this many documents: ROWS_PER_FILE of them in each, fewer where that leaves some of `tasks` without work."""
    return max(1, -(-rows // ROWS_PER_FILE), min(tasks, -(-rows // LEAST_ROWS)))


def write_records(docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int, width: int = 2, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> DataFrame:
    """Encode whole texts, append end_id to each, and write record files in ascending id order in a folder of scratch.

    Gives the manifest, a table beside the files: part, data, index, n_rows, n_tokens and start (ids in all files before)
    of each file. width 2 holds vocabularies of up to 65,536 ids, 4 any.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("row"))
    files = files or file_count(docs.count(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(files, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    written = scratch.keep(dealt.mapInArrow(_writer(scratch.path("files"), tokenizer, end_id, width), MANIFEST), "manifest").where("n_rows > 0")
    before = F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))  # a row for each file
    return written.withColumn("start", F.coalesce(before, F.lit(0)))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.to_pylist():
            start = file["start"]
            for payloads in read_records(file["data"], file["index"]):
                keys, ids = zip(*map(parsed, payloads), strict=True)
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys, pa.int64()), "start": starts, "n_tokens": sizes, "ids": pa.array(ids, pa.binary())})


def read_manifest(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all records, from the files; ids as little-endian unsigned 32-bit integers."""
    ship(manifest.sparkSession)
    files = manifest.select("data", "index", "start")
    return files.repartition(max(1, files.count())).mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids binary")


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    manifest = write_records(docs, Scratch(spark, "records"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_manifest(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op2_token_records": op2_token_records}
ORACLES: dict[str, str] = {}
