"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Two documents are linked if 100 * |A & B| >= percent * |A | B| over their sets of distinct word shingles; a component
is what links connect. The steps:

1. Every whole text becomes its set of 64-bit shingle hashes, a key of that set and `coordinates` MinHash values.
   Equal sets share a key and are one class from here on, so copies are never paired.
2. Classes are posted under each coordinate-value pair. Lists of one class vanish. A pair that matches in `matches`
   coordinates or more has to meet in the prefixes of both classes: all but the `matches` - 1 longest lists of each,
   in one global order. Those longest lists are skipped; no candidate ever comes from them.
3. The smallest class of each prefix list meets the other members. Collisions of these candidates are counted over all
   coordinates, the skipped ones too; from `matches` on, the link is confirmed on both whole sets. This settles
   most lists: those of near copies are one component then.
4. Lists that still hold several components are merged in blocks. Each class is dealt to a block of the longest list near
   it; blocks have a bounded number of classes and of shingles, and two blocks that occur in one list meet in one task.
   There collisions are counted coordinate by coordinate for classes of different components, and pairs that reach
   `matches` are confirmed by one product of their shingle matrices. A task gives only the links that a spanning forest
   of what it found needs. So no list is expanded into pairs of rows, however many texts nearly alike it holds.

At 0.8 similarity, 24 of 48 coordinates are missed with a chance below 1e-6. Links and components stay in tables in
the shared folder; the driver only sees counts.

Nulls and edges: a null text, or one without a word, has an empty set, and is linked with nothing; a text with fewer
words than a shingle is one shingle; null ids are never linked into a component of their own and are kept; rows
that repeat (id and text) are exact copies of which one is kept; texts of any length count whole; the input's other
columns pass through `drop_near_duplicates` whatever their names; an empty table gives an empty result. Sets,
shingles and classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.llm._shared import LOWER, Scratch, mix, sequence_bytes, trim, word_hashes, words

COORDINATES, MATCHES = 48, 24
#: Ids that are broadcast at most (8 bytes each); beyond it the same join is shuffled.
BROADCAST_IDS = 1_000_000

_RANDOM = np.random.RandomState(7)
_ODD = _RANDOM.randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _RANDOM.randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each row its distinct shingles of `size` words, as sorted 64-bit hashes; A-Z are lower-cased."""
    raw = LOWER[raw]
    starts, ends, row = words(raw, offsets)
    h = word_hashes(raw, starts, ends)
    n = len(h) - size + 1
    step = np.uint64(0xD6E8FEB86659FD93)
    at = np.searchsorted(row, np.arange(len(offsets)))
    grams = np.zeros(max(0, n), np.uint64)
    for j in range(size if n > 0 else 0):
        grams = grams * step + h[j : j + n]
    grams = mix(grams + np.uint64(size))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            one = np.zeros(1, np.uint64)
            for x in h[a:b]:
                one = one * step + x
            out.append(mix(one + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of each non-empty set, and its coordinate-value pairs as 64-bit values (a row for each set)."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    sizes = np.array([len(x) for x in sets], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros((0, coordinates), np.int64)
    keys = mix(np.add.reduceat(mix(flat ^ _SALT[255]), first) + sizes.astype(np.uint64)).view(np.int64)
    values = np.empty((len(sets), coordinates), np.int64)
    for k in range(coordinates):
        values[:, k] = mix(np.minimum.reduceat(flat * _ODD[k], first) ^ _SALT[k]).view(np.int64)
    return keys, values


def _signing(size: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offsets in sequence_bytes(batch, "text"):
                n = j - i
                sets = shingle_sets(raw, offsets, size)
                full = np.array([len(x) > 0 for x in sets], bool)
                keys, values = signatures([x for x in sets if len(x)], coordinates)
                place = np.cumsum(full) - 1
                ends = np.concatenate([[0], np.cumsum(full * coordinates)]).astype(np.int32)
                key = pa.array(keys[place] if len(keys) else np.zeros(n, np.int64), pa.int64(), mask=~full)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), batch.column(2).slice(i, n), pa.array([len(x) for x in sets], pa.int64()), key, pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))], names=["doc_id", "text_hash", "n_shingles", "key", "posts"])
        trim()

    return run


def _listing(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, offsets in sequence_bytes(batch, "text"):
                sets = shingle_sets(raw, offsets, size)
                keys, _ = signatures([x for x in sets if len(x)], 0)
                full = [x.view(np.int64) for x in sets if len(x)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in full])]).astype(np.int32)
                flat = np.concatenate(full) if full else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["key", "shingles"])
        trim()

    return run


def _few(ids: DataFrame) -> DataFrame:
    """ids to be broadcast if there are few enough of them."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, root): the smallest node that each node of links (a, b) is connected with.

    Every round takes the smallest label among a node and its neighbours, then that label's own label.
    """
    both = scratch.keep(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct(), f"{label}-edges")
    now = scratch.keep(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root")).select(F.col("u").alias("node"), "root"), f"{label}-0")
    k = 0
    while True:
        near = both.join(now.select(F.col("node").alias("v"), "root"), "v").groupBy("u").agg(F.min("root").alias("near")).select(F.col("u").alias("node"), "near")
        least = now.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = now.select(F.col("node").alias("root"), F.col("root").alias("far"))
        k += 1
        new = scratch.keep(least.join(jump, "root").select("node", "old", F.least("root", "far").alias("root")), f"{label}-{k}")
        changed = new.where("old <> root").limit(1).count()
        scratch.drop(f"{label}-{k - 1}")
        now = new.select("node", "root")
        if not changed:
            scratch.drop(f"{label}-edges")
            return now


def _first_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of the smallest class of each list with its other members."""
    first = members.groupBy("h").agg(F.min("key").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = first.join(members.select("h", F.col("key").alias("b")), "h").where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


#: Classes and shingles of a block, as far as a hash deals evenly; one class is never cut.
BLOCK_CLASSES, BLOCK_SHINGLES = 384, 400_000


def _block_tasks(members: DataFrame, met: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (x, y, block, key, root, posts, shingles): the classes of blocks x and y, for all blocks that share an open list.

    members: h, key, root of all prefix lists; a list is open if it holds several components.
    """
    lists = members.groupBy("h").agg(F.count("*").alias("n"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("h", "n")
    rows = scratch.keep(members.join(lists, "h"), "open")
    home = rows.groupBy("key").agg(F.max(F.struct("n", "h")).alias("home"))
    near = rows.join(home, "key").groupBy("h").agg(F.max("home").alias("home"))  # a list's classes follow the longest list that any of them is in
    home = rows.join(near, "h").groupBy("key").agg(F.max("home").alias("home"), F.first("root").alias("root"))
    sized = home.select("key", "root", F.col("home.h").alias("home")).join(sets.select("key", F.size("shingles").alias("size")), "key")
    parts = sized.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("parts"))
    dealt = scratch.keep(sized.join(parts, "home").select("key", "root", F.xxhash64("home", F.pmod(F.xxhash64("key"), F.col("parts"))).alias("block")), "blocks")
    spread = rows.select("h", "key").join(dealt.select("key", "block"), "key").select("h", "block").distinct()
    meet = spread.select("h", F.col("block").alias("x")).join(spread.select("h", F.col("block").alias("y")), "h").where("x <= y").select("x", "y").distinct()
    roots = scratch.keep(dealt.groupBy("block").agg(F.min("root").alias("low"), F.max("root").alias("high")), "block-roots")
    of = lambda side: roots.select(F.col("block").alias(side), F.col("low").alias(f"low_{side}"), F.col("high").alias(f"high_{side}"))
    several = F.least("low_x", "low_y") != F.greatest("high_x", "high_y")  # blocks of one component have nothing to tell each other
    meet = meet.join(of("x"), "x").join(of("y"), "y").where(several).select("x", "y")
    sides = meet.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    held = dealt.join(met.select("key", "posts"), "key").join(sets, "key")
    return sides.join(held, "block")


def common_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of left with all of right, as products of presence matrices, some columns at a time."""
    n, sizes = len(left), [len(x) for x in (*left, *right)]
    shingles, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out, width = np.zeros((n, len(right)), np.float32), 4096
    for begin in range(0, len(shingles), width):
        a, b = np.searchsorted(column, [begin, begin + width])
        present = np.zeros((len(sizes), width), np.float32)
        present[row[a:b], column[a:b] - begin] = 1
        out += present[:n] @ present[n:].T
    return out.astype(np.int64)


def forest(a: list[int], b: list[int]) -> list[int]:
    """Places of the links (a, b) that join what earlier ones have not."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = top(x), top(y)
        if x != y:
            parent[x] = y
            kept.append(k)
    return kept


def _merging(percent: int, matches: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        block = table.column("block").to_numpy()
        key, root = table.column("key").to_numpy(), table.column("root").to_numpy()
        posts = table.column("posts").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        same = np.zeros((len(left), len(right)), np.uint16)
        for k in range(posts.shape[1]):
            same += posts[left, k][:, None] == posts[right, k][None, :]
        maybe = (same >= matches) & (root[left][:, None] != root[right][None, :])
        if x == y:
            maybe = np.triu(maybe, 1)
        i, j = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
        if not len(i):
            return schema.empty_table()
        shingles = table.column("shingles")
        one, two = ([shingles[int(k)].values.to_numpy() for k in side] for side in (left[i], right[j]))
        common = common_shingles(one, two)
        sizes = np.array([len(s) for s in one])[:, None] + np.array([len(s) for s in two])[None, :]
        found = np.argwhere(maybe[np.ix_(i, j)] & (100 * common >= percent * (sizes - common)))
        a, b = left[i[found[:, 0]]], right[j[found[:, 1]]]
        keep = forest(root[a].tolist(), root[b].tolist())
        return pa.table([pa.array(key[a[keep]]), pa.array(key[b[keep]])], schema=schema)

    return run


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """The pairs (a, b) that match in enough coordinates and whose whole sets are similar enough."""
    side = lambda t, x, v: t.select(F.col("key").alias(x), F.col(v).alias(f"{v}_{x}"))
    close = pairs.join(side(classes, "a", "posts"), "a").join(side(classes, "b", "posts"), "b")
    close = close.where(F.size(F.array_intersect("posts_a", "posts_b")) >= matches).select("a", "b")
    both = close.join(side(sets, "a", "shingles"), "a").join(side(sets, "b", "shingles"), "b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return both.where(100 * common >= percent * (F.size("shingles_a") + F.size("shingles_b") - common)).select("a", "b")


def _signed(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, size: int, coordinates: int) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return scratch.keep(texts.mapInArrow(_signing(size, coordinates), "doc_id long, text_hash long, n_shingles long, key long, posts array<long>"), "signed")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, coordinates: int = COORDINATES, matches: int = MATCHES, scratch: Scratch | None = None) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (smallest id that links reach), kept, key (of its set), text_hash."""
    scratch = scratch or Scratch(docs.sparkSession, "near")
    signed = _signed(docs, scratch, id_col, text_col, size, coordinates)
    classes = scratch.keep(signed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("posts").alias("posts")), "classes")
    posts = classes.select("key", F.explode("posts").alias("h"))
    often = posts.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    shared = posts.join(often, "h")
    own = W.partitionBy("key")
    ranked = shared.withColumn("m", F.count("*").over(own)).withColumn("r", F.row_number().over(own.orderBy("n", "h")))
    members = scratch.keep(ranked.where(F.col("r") <= F.col("m") - (matches - 1)).select("h", "key"), "members-0")
    met = scratch.keep(members.select("key").distinct().join(classes, "key"), "met")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = texts.join(_few(met.select("doc_id").distinct()), "doc_id", "left_semi")
    sets = scratch.keep(wanted.mapInArrow(_listing(size), "key long, shingles array<long>").dropDuplicates(["key"]), "sets")
    links = scratch.keep(confirmed(_first_pairs(members), met.select("key", "posts"), sets, percent, matches), "links-0")
    roots = scratch.keep(components(links, scratch, "first"), "roots-0")
    named = members.join(roots.withColumnRenamed("node", "key"), "key", "left").select("h", "key", F.coalesce("root", "key").alias("root"))
    tasks = _block_tasks(scratch.keep(named, "members-1"), met, sets, scratch)
    more = scratch.keep(tasks.groupBy("x", "y").applyInArrow(_merging(percent, matches), "a long, b long"), "links-1")
    if more.limit(1).count():
        roots = components(links.unionByName(more), scratch, "second")
    least = classes.select("key", "doc_id")
    rooted = least.join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("root"), "doc_id")
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("doc_id"))
    least = rooted.select("key", "root").join(ids, "root").select("key", "doc_id")
    named = signed.select("doc_id", "text_hash", "n_shingles", "key").join(least.select("key", F.col("doc_id").alias("first_id")), "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first_id", "doc_id"))
    out = named.select("doc_id", "n_shingles", component.alias("component_id"), "key", "text_hash").withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    out = scratch.keep(out, "result")
    scratch.drop("signed", "classes", "met", "sets")
    return out


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs without near duplicates: of each component the document with the smallest id stays, once."""
    found = near_duplicates(docs, id_col, text_col, size, percent)
    # a row is named by its id and text, as an id may have several texts
    same = (F.col(id_col).cast("long") == F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash"))
    rows = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.first("kept").alias("kept"), F.count("*").alias("n"))
    gone, again = rows.where("not kept").select("__id", "__hash"), rows.where("kept and n > 1").select("__id", "__hash")
    rest = docs.join(_few(gone), same, "left_anti")
    if not again.limit(1).count():
        return rest
    once = docs.join(_few(again), same, "left_semi").dropDuplicates([id_col, text_col])
    return rest.join(_few(again), same, "left_anti").unionByName(once)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, size=4).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"op1_near_dedup": op1_near_dedup}
ORACLES: dict[str, str] = {}
