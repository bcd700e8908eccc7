"""Columnar frame caches: import of per-column array files, and frames as Parquet."""

from __future__ import annotations

import ast
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.shipping import ship

ROWS = 16_384


def array_header(raw: bytes) -> tuple[np.dtype, tuple[int, ...], int]:
    """Element type, shape and offset of the data of an .npy file, from its first bytes."""
    if raw[:6] != b"\x93NUMPY":
        raise ValueError("not an array file")
    size, at = (struct.unpack("<H", raw[8:10])[0], 10) if raw[6] == 1 else (struct.unpack("<I", raw[8:12])[0], 12)
    head = ast.literal_eval(raw[at : at + size].decode("latin-1"))
    if head["fortran_order"]:
        raise ValueError("column-major arrays are not supported")
    return np.dtype(head["descr"]), head["shape"], at + size


def _kind(dtype: np.dtype, shape: tuple[int, ...]) -> T.DataType:
    base = {"b": T.BooleanType(), "i": T.LongType(), "u": T.LongType(), "f": T.DoubleType()}[dtype.kind]
    return base if len(shape) == 1 else T.ArrayType(base)


def read_cache(spark: SparkSession, root: str, sources: list[str], columns: dict[str, T.DataType]) -> DataFrame:
    """source_id, idx and the named columns of each source's folder of .npy files.

    Rows are read in pieces of ROWS, of the named columns only; points of several values become flat arrays. NaN and
    infinite values become null here, once, so that no later operator meets them. A source whose columns differ in
    length is an error.
    """
    ship(spark)
    names = list(columns)
    schema = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("idx", T.LongType()), *(T.StructField(n, k) for n, k in columns.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for source in batch.column(0).to_pylist():
                files = []
                for n in names:
                    store, path = fs.FileSystem.from_uri(f"{root.rstrip('/')}/{source}/{n}.npy")
                    f = store.open_input_file(path)
                    files.append((f, *array_header(f.read(4096))))
                lengths = {shape[0] for _, _, shape, _ in files}
                if len(lengths) > 1:
                    raise ValueError(f"{source}: columns differ in length: {sorted(lengths)}")
                for begin in range(0, max(lengths, default=0), ROWS):
                    n = min(ROWS, next(iter(lengths)) - begin)
                    arrays = [pa.array([source] * n), pa.array(np.arange(begin, begin + n))]
                    for (f, dtype, shape, offset), kind in zip(files, columns.values(), strict=True):
                        width = int(np.prod(shape[1:], dtype=np.int64))
                        f.seek(offset + begin * width * dtype.itemsize)
                        values = np.frombuffer(f.read(n * width * dtype.itemsize), dtype)
                        flat = pa.array(values.astype(float), mask=~np.isfinite(values)) if dtype.kind == "f" else pa.array(values if dtype.kind == "b" else values.astype(np.int64))
                        arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), flat) if isinstance(kind, T.ArrayType) else flat)
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    folders = spark.createDataFrame([(s,) for s in sources], "source string").repartition(max(1, len(sources)))
    return folders.mapInArrow(run, schema)


def write_frames(frames: DataFrame, path: str, key: str = "source_id", idx: str = "idx", parts: int | None = None) -> None:
    """Frames as Parquet, each source's rows together and in order, so that windows over (key, idx) read sorted runs."""
    dealt = frames.repartition(parts, key) if parts else frames.repartition(key)
    dealt.sortWithinPartitions(key, idx).write.mode("overwrite").parquet(path)


def with_defaults(observed: DataFrame, flags: list[str], counts: list[str]) -> DataFrame:
    """Observations with missing flags false and missing counts 0; missing measurements stay null."""
    return observed.withColumns({f: F.coalesce(f, F.lit(False)) for f in flags} | {c: F.coalesce(c, F.lit(0)) for c in counts})
