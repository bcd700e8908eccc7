"""Chat formatting: roles recovered by a hidden Markov model, then canonical turns.

A row is a piece of a conversation: its text may be one turn or a raw transcript. Text is cut into segments before
each line that opens with a speaker marker (`User:`, `### Assistant`, ...), and every segment gets features of its
marker, its lines and its length. A marker ends in a colon, or is a tag or bracket (`<|user|>`, `[user]`), or stands alone
on its line with text after it; one letter (`q`, `a`) needs the colon or the `<|q|>` form, as it may be a list's label. States are roles; start and transition probabilities and those of the features are
counted on labelled rows of one segment, and Viterbi decoding finds the most probable roles of a whole conversation.

All segments are put in one order, by conversation, turn, row and place in the row, and numbered along it by a range
sort, so neither a very long conversation nor a very long row is one task. BLOCK numbers in a row are a block. The
part of a conversation in a block is first reduced to a matrix of best scores from each role before it to each role at
its end; the matrices of a conversation, one small row for each block, are chained; then the blocks are decoded between
the roles chosen for their ends. Scores are fixed-point numbers, so that ties are exact (they go to the role first in
ROLES).

Nulls and edges: a null text has no line and keeps its row; a null conversation id is a conversation; turns are in
the order of their number (null first) and, where equal, of a hash of their text, so that the segments of a row stay
together; rows that repeat are decoded as turns of their own; a row of several segments has no one role and teaches
none; labels are only read in training; control characters in a text are text; an empty table gives an empty result;
result columns replace input columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cadenza.llm._shared import Scratch
from cadenza.llm.language_id import held_out

ROLES = ("system", "user", "assistant")
BLOCK = 4096
#: Speaker markers at the start of a line, by the role that they hint at.
MARKERS = (("system", "system|instructions?|context"), ("user", "user|human|customer|question|q"), ("assistant", "assistant|ai|bot|agent|answer|a"))
_ANY = "(?:" + "|".join(m for _, m in MARKERS) + ")"
_WORD = rf"(?:(?![qa]\b){_ANY})"
MARKER_LINE = (
    rf"(?mi)^[ \t]*(?:(?:#{{1,4}}[ \t]*|<\|?|\[|\*{{1,2}})?{_ANY}(?:\|?>|\]|\*{{1,2}})?[ \t]*:"
    rf"|<\|{_ANY}\|>|<{_WORD}>|\[{_WORD}\](?!\()"
    rf"|(?:#{{1,4}}[ \t]*{_WORD}|\*{{1,2}}{_WORD}\*{{1,2}}|{_WORD})[ \t]*$(?=\s*\S))[ \t]*"
)
SCALE = 1_000_000
#: Turns that each role's own marker counts as seen with it before training, so that markers speak even where labelled text has none.
MARKER_PRIOR = 100
FEATURES = ("marker", "size", "lines", "asks", "opens")


#: Characters that cutting uses, and what stands for them behind U+0003 meanwhile.
_ESCAPED = (("\u0003", "c"), ("\u0001", "a"), ("\u0002", "b"))


def segments(text: Column) -> Column:
    """Array of struct(marker, body): the text cut before each marker line; without markers one segment."""
    safe = F.coalesce(text, F.lit(""))
    for c, name in _ESCAPED:
        safe = F.replace(safe, F.lit(c), F.lit("\u0003" + name))
    marked = F.regexp_replace(safe, MARKER_LINE, "\u0001$0\u0002")
    pieces = F.split(marked, "\u0001", -1)
    pieces = F.filter(pieces, lambda p, i: (i > 0) | (F.trim(p) != "") | (F.size(pieces) == 1))

    def cut(p: Column) -> Column:
        has = F.locate("\u0002", p) > 0
        body = F.when(has, F.substring_index(p, "\u0002", -1)).otherwise(p)
        for c, name in reversed(_ESCAPED):
            body = F.replace(body, F.lit("\u0003" + name), F.lit(c))
        return F.struct(F.when(has, F.lower(F.substring_index(p, "\u0002", 1))).alias("marker"), body.alias("body"))

    return F.transform(pieces, cut)


def with_features(rows: DataFrame) -> DataFrame:
    """rows (marker, body, turn, part) with one small category for each of FEATURES."""
    marker = F.lit("none")
    for role, words in reversed(MARKERS):
        marker = F.when(F.col("marker").rlike(rf"(?i)^[^a-z]*(?:{words})[^a-z]*$"), F.lit(role)).otherwise(marker)
    size = F.floor(F.log2(F.length("body") + 1.0) * 2).cast("string")
    lines = F.least(F.regexp_count("body", F.lit(r"(?m)^.*\S.*$")), F.lit(8)).cast("string")
    asks = F.col("body").rlike(r"\?[ \t]*(?:\n|$)").cast("string")
    opens = ((F.coalesce("turn", F.lit(0)) == 0) & (F.col("part") == 0)).cast("string")
    return rows.withColumns({"marker": F.when(F.col("marker").isNull(), "none").otherwise(marker), "size": size, "lines": lines, "asks": asks, "opens": opens})


class Model:
    """Fixed-point log-probabilities: emit[feature][value] by role, and the matrix of steps; its last row starts a conversation."""

    def __init__(self, emit: dict[str, dict[str, list[int]]], step: np.ndarray) -> None:
        self.emit, self.step = emit, step


def _log(n: float, total: float, kinds: int) -> int:
    return round(SCALE * math.log((n + 1) / (total + kinds)))


def learn(rows: DataFrame) -> Model:
    """From numbered segments with features, parts and role; rows of several segments and null or unknown roles are left out.

    Counts only reach the driver, a row for each category.
    """
    known = rows.where(F.col("role").isin(*ROLES) & (F.col("parts") == 1))
    emit: dict[str, dict[str, list[int]]] = {}
    stacked = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES))).alias("x")
    counts = known.select("role", stacked).groupBy("role", "x.feature", "x.value").agg(F.count("*").alias("n")).collect()
    for f in FEATURES:
        of = {(r["role"], r["value"]): r["n"] for r in counts if r["feature"] == f}
        if f == "marker":
            for role in ROLES:
                of[role, role] = of.get((role, role), 0) + MARKER_PRIOR
        values = sorted({v for _, v in of})
        totals = {role: sum(of.get((role, v), 0) for v in values) for role in ROLES}
        emit[f] = {v: [_log(of.get((role, v), 0), totals[role], len(values) + 1) for role in ROLES] for v in values}
    # the role of a row and that of the one before; first rows of conversations follow none
    before = rows.select((F.col("number") + 1).alias("number"), F.col("conv_id").alias("c"), F.when(F.col("parts") == 1, F.col("role")).alias("previous"), F.lit(True).alias("any"))
    both = known.select("number", "conv_id", "role").join(before, "number", "left")
    inside = F.coalesce("any", F.lit(False)) & F.col("conv_id").eqNullSafe(F.col("c"))
    pairs = both.select("role", inside.alias("inside"), F.when(inside, F.col("previous")).alias("previous")).groupBy("inside", "previous", "role").agg(F.count("*").alias("n")).collect()
    seen = {(r["previous"], r["role"]): r["n"] for r in pairs if (r["previous"] in ROLES) == r["inside"]}
    step = np.array([[_log(seen.get((p, r), 0), sum(seen.get((p, x), 0) for x in ROLES), len(ROLES)) for r in ROLES] for p in (*ROLES, None)], np.int64)
    return Model(emit, step)


def emissions(model: Model) -> Column:
    """Array of the three roles' scores of a segment; a category that training lacks says nothing."""
    total = [F.lit(0).cast("long") for _ in ROLES]
    for f in FEATURES:
        for k in range(len(ROLES)):
            score = F.lit(0).cast("long")
            for value, logs in model.emit.get(f, {}).items():
                score = F.when(F.col(f) == value, F.lit(logs[k]).cast("long")).otherwise(score)
            total[k] = total[k] + score
    return F.array(*total)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with the same conv_id and block, in the order in which they come."""
    key, run = None, []
    for batch in batches:
        for row in batch.to_pylist():
            k = (row["conv_id"], row["block"])
            if run and k != key:
                yield key, run
                run = []
            key = k
            run.append(row)
    if run:
        yield key, run


_LOW = np.int64(-(1 << 60))


def _reducing(step: np.ndarray):
    """Of each block the best scores from each role before it (the last: none, it starts) to each role at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {"conv_id": [], "block": [], "first": [], "best": []}

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array(out[k], pa.int64()) for k in ("conv_id", "block", "first")), pa.array(out["best"], pa.list_(pa.int64()))], names=list(out))

        for (conv, block), rows in _groups(batches):
            scores = step + np.array(rows[0]["e"], np.int64)
            for row in rows[1:]:
                scores = (scores[:, :, None] + step[None, :-1, :]).max(axis=1) + np.array(row["e"], np.int64)
            for name, x in zip(out, (conv, block, rows[0]["number"], scores.ravel().tolist()), strict=True):
                out[name].append(x)
            if len(out["block"]) >= 10_000:
                yield made()
                out = {k: [] for k in out}
        yield made()

    return run


def chained(blocks: list[list[int]]) -> list[tuple[int, int]]:
    """Roles before (3: none) and at the end of each block of one conversation, given the blocks' best scores in order."""
    n, score, back = len(ROLES), None, []
    for k, best in enumerate(blocks):
        m = np.array(best, np.int64).reshape(n + 1, n)
        if k == 0:
            score = m[n]
            back.append(np.full(n, n))
        else:
            through = score[:, None] + m[:n]
            back.append(through.argmax(axis=0))
            score = through.max(axis=0)
    ends, role = [], int(score.argmax())
    for b in reversed(back):
        ends.append((int(b[role]), role))
        role = int(b[role])
    return ends[::-1]


def _chaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(conv, rows) -> pa.RecordBatch:
        ends = chained([r["best"] for r in rows])
        return pa.RecordBatch.from_pydict({"conv_id": pa.array([conv] * len(rows), pa.int64()), "first": pa.array([rows[0]["first"]] * len(rows), pa.int64()), "block": pa.array([r["block"] for r in rows], pa.int64()), "before": pa.array([a for a, _ in ends], pa.int32()), "last": pa.array([b for _, b in ends], pa.int32())})

    conv, run = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if run and row["conv_id"] != conv:
                yield flush(conv, run)
                run = []
            conv = row["conv_id"]
            run.append(row)
    if run:
        yield flush(conv, run)


def viterbi(emit: np.ndarray, step: np.ndarray, before: int, last: int | None = None) -> list[int]:
    """Best roles of a run of segments after role `before` (3: none), ending in role `last` if given."""
    score, back = step[before] + emit[0], []
    for e in emit[1:]:
        through = score[:, None] + step[:-1]
        back.append(through.argmax(axis=0))
        score = through.max(axis=0) + e
    role = int(score.argmax()) if last is None else last
    out = [role]
    for b in reversed(back):
        role = int(b[role])
        out.append(role)
    return out[::-1]


def _decoding(step: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            roles = viterbi(np.array([r["e"] for r in rows], np.int64), step, rows[0]["before"], rows[0]["last"])
            columns = {"number": pa.array([r["number"] for r in rows], pa.int64()), "place": pa.array([r["number"] - r["first"] for r in rows], pa.int64()), "role_pred": pa.array([ROLES[r] for r in roles], pa.string())}
            yield pa.RecordBatch.from_pydict({k: columns[k] for k in names})

    return run


def rendered(role: Column, body: Column) -> Column:
    """A turn in canonical form: role header, trimmed body with bare line feeds, end mark."""
    clean = F.regexp_replace(F.regexp_replace(body, r"\r\n?", "\n"), r"[ \t]+(?=\n|$)", "")
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.regexp_replace(clean, r"^\s+|\s+$", ""), F.lit("<|end|>\n"))


def in_order(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """rows, whose order is unique, with number: their place from 0 along it. A range sort: no task holds more than its share."""
    piece, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    held = scratch.keep(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), name).withColumn("piece", piece)
    sizes = held.groupBy("piece").agg(F.count("*").alias("n"))  # a row for each task of the sort
    before = F.coalesce(F.sum("n").over(W.orderBy("piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return held.join(F.broadcast(sizes.select("piece", before.alias("ahead"))), "piece").withColumn("number", F.col("ahead") + place).drop("piece", "at", "ahead")


def parse(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, turn, place (in the conversation, from 0), part (in the row), role, held_out, role_pred and rendered of every segment of rows (conv_id, turn, role, text, held_out)."""
    named = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "held_out", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), segments(F.col("text")).alias("s"))
    cut = named.select("conv_id", "turn", "role", "held_out", "tie", "row", F.size("s").alias("parts"), F.posexplode("s").alias("part", "x")).select("*", "x.marker", "x.body").drop("x")
    featured = scratch.keep(with_features(cut), "cut")
    ordered = in_order(featured, ["conv_id", "turn", "tie", "role", "row", "part"], scratch, "ordered")
    scratch.drop("cut")
    model = learn(ordered.where(~F.col("held_out")))
    scored = ordered.select("conv_id", "number", F.floor(F.col("number") / BLOCK).alias("block"), emissions(model).alias("e"))
    best = scored.repartition("block").sortWithinPartitions("number").mapInArrow(_reducing(model.step), "conv_id long, block long, first long, best array<long>")
    ends = best.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_chaining, "conv_id long, first long, block long, before int, last int")
    ends = scratch.keep(ends, "ends").select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "first", "before", "last")
    with_ends = scored.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    names = ["number", "place", "role_pred"]
    found = with_ends.repartition("block").sortWithinPartitions("number").mapInArrow(_decoding(model.step, names), "number long, place long, role_pred string")
    out = ordered.select("number", "conv_id", "turn", "part", "role", "held_out", "body").join(found, "number")
    return out.select("conv_id", "turn", "place", "part", "role", "held_out", "role_pred", rendered(F.col("role_pred"), F.col("body")).alias("rendered"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return parse(rows.withColumn("held_out", held_out(F.col("conv_id"), 5, 0)), Scratch(spark, "chat"))


QUERIES = {"op10_chat_format": op10_chat_format}
ORACLES: dict[str, str] = {}
