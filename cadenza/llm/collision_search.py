"""Nearest vectors by inner product with collision-counting hashing.

Each of PROJECTIONS random projections is one sorted array of all vectors of a block. A query opens a window of the same
half-width around its own value in every array, and a vector collides once for each window that it lies in. Windows
widen together by GROWTH (virtual rehashing: the arrays stay, nothing is hashed anew) until enough vectors have collided in a share THRESHOLD of the windows. Those alone are verified, by their exact inner
products in double precision. Enough are VERIFY * sqrt(all vectors) and 4 * `k`, spread over the blocks: of 50,000 vectors
about 2 in a hundred, and the share falls as the table grows. For inner products to order as distances do, vectors get one more
component that brings all to the largest norm.

A sorted array is cut into runs of equal numbers of vectors, and kept as bit sets of the vectors up to each cut: the
vectors of a window are the difference of two of them, and collisions of all vectors are added up at once, bit by bit, in
CARRY bit sets that hold the binary digits of the counts. Windows are widened outward to whole runs.

The queries are a stated set; they meet all vectors in blocks. Every vector is indexed; blocks bound what a task
holds, whatever the number of vectors. Tests measure recall against brute force, also on near-random vectors of 64
components, the hardest case.

Nulls and edges: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a
null id; vectors of different lengths are different tables, a query meets those of its length; a row is no candidate
of itself only: rows that repeat, or share an id, are queries and candidates of their own, told apart by `query_row`;
equal inner products go to the smaller id; with fewer than `k` candidates all are returned; an empty table gives an
empty result; other input columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.llm._shared import Scratch, trim

PROJECTIONS, THRESHOLD, GROWTH, VERIFY = 128, 0.82, 1.02, 4.0
#: Runs that a sorted array is cut into, and binary digits of a count.
RUNS, CARRY = 256, 8
VECTORS, QUERIES_AT_ONCE = 16_384, 2048
#: Queries whose windows are counted together, and those that the first half-width is found from.
TOGETHER, PROBES = 32, 16
#: Steps of GROWTH before half-widths double, and lengths of vectors whose few figures are broadcast at most.
PATIENCE, LENGTHS = 100, 10_000


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def axes(size: int) -> np.ndarray:
    """PROJECTIONS unit vectors of this many components, as bases that are orthogonal each."""
    random = np.random.RandomState(11)
    bases = [np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(-(-PROJECTIONS // size))]
    return np.concatenate(bases, axis=1)[:, :PROJECTIONS]


class Index:
    """Sorted projections of one block, and the bit sets of the vectors before each cut."""

    def __init__(self, vectors: np.ndarray, largest: float) -> None:
        self.vectors, n = vectors, len(vectors)
        unit = vectors / largest
        lifted = np.concatenate([unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))[:, None]], axis=1)
        self.axes = axes(lifted.shape[1])
        values = lifted @ self.axes
        order = np.argsort(values, axis=0, kind="stable")
        self.scale = max(float(values.std()), 1e-12)
        self.run = -(-n // RUNS)
        self.words = -(-n // 64)
        self.first = np.take_along_axis(values, order[:: self.run], axis=0).T.copy()  # the least value of each run
        runs = self.first.shape[1]
        self.before = np.zeros((PROJECTIONS, runs + 1, self.words), np.uint64)
        here = np.zeros((runs, self.words * 64), np.uint8)
        for j in range(PROJECTIONS):
            here[:] = 0
            here[np.arange(n) // self.run, order[:, j]] = 1
            bits = np.packbits(here, axis=1, bitorder="little").view(np.uint64)
            np.bitwise_or.accumulate(bits, axis=0, out=self.before[j, 1:])

    def windows(self, at: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """First run of the window around each value (a row for each projection), and the run after its last."""
        lo, hi = np.empty(at.shape, np.int64), np.empty(at.shape, np.int64)
        for j in range(PROJECTIONS):
            lo[j] = np.searchsorted(self.first[j], at[j] - half * self.scale, "left")
            hi[j] = np.searchsorted(self.first[j], at[j] + half * self.scale, "right")
        return np.maximum(lo - 1, 0), hi

    def count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Collisions of all vectors with the windows of each query, as CARRY bit sets: the binary digits of the counts.

        Bit sets of eight projections are added up by carry-save adders before their carry goes on to the higher digits.
        """
        shape = (lo.shape[1], self.words)
        digits = np.zeros((CARRY, *shape), np.uint64)
        sets, spare = np.empty((8, *shape), np.uint64), np.empty(shape, np.uint64)

        def add(total: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
            """total becomes the sum's digit, x the carry."""
            np.bitwise_xor(total, x, out=spare)
            np.bitwise_and(total, x, out=x)
            np.bitwise_xor(spare, y, out=total)
            np.bitwise_and(spare, y, out=spare)
            return np.bitwise_or(x, spare, out=x)

        for j in range(0, PROJECTIONS, 8):
            for k in range(8):
                np.take(self.before[j + k], hi[j + k], axis=0, out=sets[k], mode="clip")
                sets[k] ^= self.before[j + k].take(lo[j + k], axis=0)
            twos = [add(digits[0], sets[k], sets[k + 1]) for k in (0, 2, 4, 6)]
            fours = [add(digits[1], twos[0], twos[1]), add(digits[1], twos[2], twos[3])]
            carry = add(digits[2], *fours)
            for d in digits[3:]:
                d ^= carry  # the sum's digit; where it turned to 0 there is a carry
                np.invert(d, out=spare)
                carry &= spare
        return digits

    @staticmethod
    def reached(digits: np.ndarray, least: int) -> np.ndarray:
        """Bit sets of the vectors with `least` collisions or more."""
        more, same = np.zeros_like(digits[0]), np.full_like(digits[0], np.uint64(0xFFFFFFFFFFFFFFFF))
        for k in range(len(digits) - 1, -1, -1):
            if least >> k & 1:
                same &= digits[k]
            else:
                more |= same & digits[k]
                same &= ~digits[k]
        return more | same

    def places(self, queries: np.ndarray) -> np.ndarray:
        norms = np.sqrt((queries * queries).sum(axis=1))[:, None]
        return (np.concatenate([queries / norms, np.zeros((len(queries), 1))], axis=1) @ self.axes).T.copy()

    def candidates(self, queries: np.ndarray, wanted: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each query the places of the vectors that collide often enough, `wanted` of them or more."""
        n, least = len(self.vectors), int(np.ceil(THRESHOLD * PROJECTIONS))
        wanted = min(n, wanted)
        at = self.places(queries)
        probes = np.linspace(0, len(queries) - 1, min(PROBES, len(queries))).astype(np.int64)
        half = min((h for _, h, _ in self._widened(at[:, probes], probes, 0.3, GROWTH**3, wanted, least)), default=1.0) / GROWTH
        for i in range(0, len(queries), TOGETHER):
            own = np.arange(i, min(len(queries), i + TOGETHER))
            for q, _, found in self._widened(at[:, own], own, half, GROWTH, wanted, least):
                yield q, found

    def _widened(self, at: np.ndarray, names: np.ndarray, half: float, growth: float, wanted: int, least: int) -> Iterator[tuple[int, float, np.ndarray]]:
        n, rounds = len(self.vectors), 0
        while len(names):
            hits = self.reached(self.count(*self.windows(at, half)), least)
            done = np.bitwise_count(hits).sum(axis=1) >= wanted
            for k in np.flatnonzero(done).tolist():
                yield int(names[k]), half, np.flatnonzero(np.unpackbits(hits[k].view(np.uint8), bitorder="little")[:n])
            rounds += 1  # a query far from all vectors needn't wait for small steps
            names, at, half = names[~done], at[:, ~done], half * (growth if rounds < PATIENCE else 2)

    def search(self, rows: np.ndarray, ids: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, k: int, wanted: int):
        """(place of the query, rows, ids, exact inner products, vectors verified) of the k best candidates of each query."""
        for i, found in self.candidates(queries, wanted):
            found = found[rows[found] != query_rows[i]]
            exact = (self.vectors[found] * queries[i]).sum(axis=1)
            if len(found) > k:
                near = np.flatnonzero(exact >= np.partition(exact, len(exact) - k)[len(exact) - k])
            else:
                near = np.arange(len(found))
            best = near[np.lexsort((rows[found][near], ids[found][near], -exact[near]))[:k]]
            yield i, rows[found][best], ids[found][best], exact[best], len(found)


_ARROW = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("verified", pa.int64())])
SCHEMA = "query_row long, query_id long, row long, vec_id long, score double, verified long"


def _searching(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return _ARROW.empty_table()
        one = lambda table, c: table.column(c).to_numpy()
        rows, ids, query_rows = one(vectors, "row"), one(vectors, "vec_id"), one(queries, "row")
        index = Index(_matrix(vectors.column("embedding")), vectors.column("largest")[0].as_py())
        found = list(index.search(rows, ids, query_rows, _matrix(queries.column("embedding")), k, vectors.column("wanted")[0].as_py()))
        sizes, places = [len(x[1]) for x in found], [x[0] for x in found]
        out = [np.repeat(query_rows[places], sizes), np.repeat(one(queries, "vec_id")[places], sizes), *(np.concatenate([x[c] for x in found]) for c in (1, 2, 3)), np.repeat([x[4] for x in found], sizes)]
        del index
        trim()
        return pa.table([pa.array(x, f.type) for x, f in zip(out, _ARROW, strict=True)], schema=_ARROW)

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scratch: Scratch | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score, query_row, verified): the k nearest found of each row where is_query holds, among all other rows.

    query_row tells apart queries with the same id; verified is the number of vectors whose inner product was taken.
    """
    scratch = scratch or Scratch(vectors.sparkSession, "nearest")
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    usable = vectors.where(F.col(id_col).isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
    usable = usable.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    usable = scratch.keep(usable.withColumn("size", F.size("embedding")), "rows")  # row numbers stay as they are from here
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    sizes = usable.groupBy("size").agg(F.count("*").alias("n"), F.count_if("asks").alias("asking"), F.max(norm).alias("largest"))
    parts, askers = F.ceil(F.col("n") / VECTORS), F.greatest(F.lit(1), F.ceil(F.col("asking") / QUERIES_AT_ONCE))
    wanted = F.ceil((VERIFY * F.sqrt("n") + 4 * k) / parts)
    sizes = scratch.keep(sizes.select("size", "largest", parts.alias("parts"), askers.alias("askers"), wanted.alias("wanted")), "sizes")  # a row for each length of vectors
    dealt = usable.join(F.broadcast(sizes) if sizes.count() <= LENGTHS else sizes, "size")
    block = lambda count: F.pmod(F.xxhash64("row"), F.col(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), (F.col(count) - 1).cast("int")))
    queries = dealt.where("asks").select(F.col("size").alias("length"), F.col("row").alias("row"), F.col("vec_id").alias("vec_id"), F.col("embedding").alias("embedding"), block("askers").alias("q"), each("parts").alias("p"))
    data = dealt.select("size", "row", "vec_id", "embedding", "largest", "wanted", block("parts").alias("p"), each("askers").alias("q"))
    found = queries.groupBy("length", "q", "p").cogroup(data.groupBy("size", "q", "p")).applyInArrow(_searching(k), SCHEMA)
    order = W.partitionBy("query_row")
    ranked = found.withColumn("rank", F.row_number().over(order.orderBy(F.desc("score"), "vec_id", "row"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "query_row", "verified")


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


QUERIES = {"op6_nearest_vectors": op6_nearest_vectors}
ORACLES: dict[str, str] = {}
