"""Language-model scores by online logistic context mixing.

A text is its lower-cased words and one end, and every token is a run of binary decisions. First a path through a
prefix code: it ends in `other`, or in the size of the place of a training word met twice or more in the order of their
counts, and that many bits of the place follow; an `other` word is spelled, its bytes and a terminator, each byte a path through
another prefix code. The probability of a text is
the product over its decisions.

* Predictors: four tables, each with a bin or more for every (word, class) counted, hold how often each bit followed a hashed context in training. In the
  order of words: the bits so far, alone and with the class of the passage. In a spelled word: the last four and six
  bytes, and the last two and three with that class. A bin's input is the log-odds of its counts, near 0 where it has
  seen little. The class is a hash of the most frequent short word among the CHUNK words before; it stands for
  language and register, and looks only back. Words of the same size of place are ordered by their commonest class.
* Mixing: inputs are summed by weights of a set that a gate selects, by the kind of decision and whether its most
  specific context has been seen. The weights start alike for every text and are refined by the text itself: after
  each CHUNK of words, each set moves along the gradient of the coding cost. All texts of a block advance together.
* Passages: places where a hash of the two preceding words says so, some RUN apart, and the third token, cut a text into
  runs. Where those two words were followed in training by a run met twice or more, one decision says whether such
  a run follows now, and its share among them says which one; the run's tokens then cost nothing else. The inputs of
  that decision are the log-odds of the counts of its hashed context and a constant, its gate is the outcome of
  the text's previous one, and the weights move after each. Runs are counted and looked up by shuffle, over all
  training texts, so they grow with the corpus and are broadcast nowhere.

Training reads all training texts: (word, class) counts are gathered over the whole corpus and entered into the
tables, partition by partition, and the bins that were met are summed. What is broadcast is the quantised tables and
the vocabulary, which grow with the counted rows (four bytes or more for each) and with the words met twice (17 bytes
each), and, for the unigram base score, the counts of up to KNOWN_WORDS distinct words; with more words, the counts
are joined by shuffle instead, to the same result.

Nulls and edges: a null text is an empty one and has the end only; null ids are not held out; a text of any length is
scored whole; repeated rows are each scored, and count each in training; with no training text every input is 0; an empty table gives an empty
result. Words are told apart by 64-bit hashes in the base score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm._shared import LOWER, Scratch, mix, slices, text_bytes, trim, word_hashes, words
from cadenza.llm.language_id import held_out

CHUNK, SHORT, CLASSES = 48, 3, 256
#: Least bits of a bin, and bits of a slice of a table.
TABLE_BITS, SLICE_BITS, MODELS = 21, 16, 4
SCALE = 12.0
BLOCK = 2 << 20
KNOWN_WORDS = 5_000_000
#: (word, class) rows entered by one task, and decisions that it holds at once.
ROWS_PER_TABLE, HELD = 1_500_000, 8 << 20
TERMINATOR, END = 32, 10
#: Symbols of the first path: `other`, and sizes of places.
OTHER, SIZES = 0, 32
#: Tokens of a run of a passage, on average.
RUN = 32
#: Bits of a place that see the class; those further on differ little between classes.
CLASS_DEPTH = 12
#: Weights at the start of a text: for places (a context of the class unseen or seen), and for spelling (six bytes unseen or seen).
START = (np.array([[0.9, 0.0], [0.2, 0.8]], np.float32), np.array([[0.4, 0.5, 0.35, 0.0], [0.3, 0.4, 0.25, 0.3]], np.float32))
RATE = 0.02
#: For passages: weights of log-odds and constant at the start, where the text's previous decision is none, was no, was yes; and their rate.
PASSAGE_START, PASSAGE_RATE = np.array([[1.0, 0.0], [0.8, -1.0], [1.0, 1.5]]), 0.1
_END_HASH = np.uint64(0x5851F42D4C957F2D)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def prefix_code(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code length of each symbol, and its path: the node and the bit at each step. Symbols that don't occur have a code too."""
    symbols = new = len(counts)
    heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x], parent[y] = (new, 0), (new, 1)
        heapq.heappush(heap, (a + b, new, new))
        new += 1
    paths = []
    for s in range(symbols):
        path, at = [], s
        while at in parent:
            at, bit = parent[at]
            path.append((at - symbols, bit))
        paths.append(path[::-1])
    size = np.array([len(p) for p in paths], np.int64)
    node, bit = np.zeros((symbols, size.max()), np.uint64), np.zeros((symbols, size.max()), np.uint8)
    for s, path in enumerate(paths):
        for k, (n, b) in enumerate(path):
            node[s, k], bit[s, k] = n, b
    return size, node, bit


def _pair_code(h: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return h ^ mix(kind.astype(np.uint64) + np.uint64(1))


class Tokens:
    """The tokens of some rows, in order, the end of each row last: spans in raw, hash, row, class and chunk."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        n = len(offsets) - 1
        raw = LOWER[raw]
        starts, ends, row = words(raw, offsets)
        h = word_hashes(raw, starts, ends)
        order = np.argsort(np.concatenate([row, np.arange(n)]), kind="stable")
        self.raw = np.append(raw, np.uint8(END))
        self.start = np.concatenate([starts, np.full(n, len(raw))])[order]
        self.end = np.concatenate([ends, np.full(n, len(raw) + 1)])[order]
        self.hash = np.concatenate([h, np.full(n, _END_HASH)])[order]
        self.row = np.concatenate([row, np.arange(n)])[order]
        first = np.searchsorted(self.row, np.arange(n))
        self.chunk = (np.arange(len(self.row)) - first[self.row]) // CHUNK
        new = np.concatenate([[True], (self.chunk[1:] != self.chunk[:-1]) | (self.row[1:] != self.row[:-1])]) if len(self.row) else np.zeros(0, bool)
        part = np.cumsum(new) - 1
        short = (self.end - self.start <= SHORT) & (self.hash != _END_HASH)
        code, count = np.unique((part[short].astype(np.uint64) << np.uint64(12)) | (self.hash[short] & np.uint64(4095)), return_counts=True)
        at = (code >> np.uint64(12)).astype(np.int64)
        best = np.lexsort((code, -count, at))
        best = best[np.concatenate([[True], at[best][1:] != at[best][:-1]])] if len(best) else best
        kind = np.zeros(int(part[-1]) + 2 if len(part) else 1, np.int64)  # of the chunk before; 0: none, or no short word in it
        kind[at[best] + 1] = 1 + (mix(code[best] & np.uint64(4095)) % np.uint64(CLASSES - 1)).astype(np.int64)
        self.kind = np.where(self.chunk > 0, kind[part], 0) if len(part) else np.zeros(0, np.int64)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place, inverse and count of each (word, class)."""
        code = _pair_code(self.hash, self.kind)
        _, first, inverse, count = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        return first, inverse, count


class Vocabulary:
    """Words with a place: sorted hashes, and the size and the bits of each place."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> None:
        rank = np.empty(len(hashes), np.int64)
        rank[np.lexsort((hashes, -counts))] = np.arange(1, len(hashes) + 1)
        size = np.floor(np.log2(rank)).astype(np.int64) if len(rank) else rank
        order = np.lexsort((hashes, -counts, kinds, size))
        place = np.empty(len(hashes), np.int64)
        place[order] = np.arange(len(hashes)) - ((1 << size[order]) - 1)
        by_hash = np.argsort(hashes)
        self.hashes, self.size, self.place, self.kind = hashes[by_hash], size[by_hash].astype(np.int8), place[by_hash].astype(np.int32), kinds[by_hash].astype(np.int32)
        self.tokens = np.bincount(size, weights=counts, minlength=SIZES)  # by size

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether each hash has a place, its size and bits, and the word's commonest class."""
        if not len(self.hashes):
            return np.zeros(len(h), bool), *(np.zeros(len(h), np.int64) for _ in range(3))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return self.hashes[at] == h, self.size[at].astype(np.int64), self.place[at].astype(np.int64), self.kind[at]


def _runs(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of n entries: the run of each entry and its place in it."""
    run = np.repeat(np.arange(len(n), dtype=np.int32), n)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)


_CLASS = np.uint64(0xD1B54A32D192ED03)
_NONE = np.int32(-1)


def table_bits(rows: int) -> int:
    """Bits of a bin, for tables with at least as many bins as (word, class) rows."""
    return max(TABLE_BITS, (rows - 1).bit_length())


def _bin(context: np.ndarray, bits: int) -> np.ndarray:
    return (mix(context) >> np.uint64(64 - bits)).astype(np.int32)


class Decisions:
    """A run of binary decisions for each word: how many, and of each its bins in the tables (none: -1) and its bit."""

    def __init__(self, n: np.ndarray, bins: list[np.ndarray], bit: np.ndarray) -> None:
        self.n, self.begin, self.bins, self.bit = n, np.cumsum(n) - n, bins, bit


def placed(kind: np.ndarray, known: np.ndarray, size: np.ndarray, place: np.ndarray, code, bits: int = TABLE_BITS) -> Decisions:
    """The path to the size of each word's place, or to `other`, and the bits of the place."""
    length, node, path = code
    symbol = np.where(known, size + 1, OTHER)
    word, step = _runs(length[symbol] + np.where(known, size, 0))
    own = symbol[word]
    depth = step - length[own]
    deep = depth >= 0
    left = np.where(deep, size[word] - depth, 1)  # bits from this one on
    on_path = np.minimum(step, node.shape[1] - 1)
    bit = np.where(deep, place[word] >> (left - 1) & 1, path[own, on_path]).astype(np.uint8)
    context = np.where(deep, own << 40 | depth << 32 | place[word] >> left, node[own, on_path].astype(np.int64)).astype(np.uint64)
    classed = _bin(context + (kind[word].astype(np.uint64) + np.uint64(1)) * _CLASS, bits)
    classed[depth > CLASS_DEPTH] = _NONE
    return Decisions(np.bincount(word, minlength=len(kind)), [_bin(context, bits), classed], bit)


def spelled(raw: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray, code, bits: int = TABLE_BITS) -> Decisions:
    """The bytes of words, and the terminator of each."""
    is_end = raw[start] == END
    word, place = _runs(end - start + ~is_end)
    symbol = raw[np.minimum(start[word] + place, len(raw) - 1)]
    symbol[(place == (end - start)[word]) & ~is_end[word]] = TERMINATOR
    recent, back = np.zeros(len(symbol), np.uint64), []
    for k in range(1, 7):
        s = np.zeros(len(symbol), np.uint64)
        s[k:] = symbol[:-k]
        s[place < k] = 1
        recent |= s << np.uint64(8 * (k - 1))
        back.append(recent.copy())
    k = kind.astype(np.uint64)[word] + np.uint64(1)
    contexts = [back[3] | np.uint64(1 << 60), back[2] + k * _CLASS, back[1] + k * _ODD, back[5] | np.uint64(3 << 60)]
    length, node, bit = code
    at, step = _runs(length[symbol])
    own = symbol[at]
    nodes = (node[own, step] + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return Decisions(np.bincount(word, weights=length[symbol], minlength=len(start)).astype(np.int64), [((mix(c).take(at) + nodes) * _ODD >> np.uint64(64 - bits)).astype(np.int32) for c in contexts], bit[own, step])


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, kind, word, n) of texts: counted in blocks, then summed over the blocks of an Arrow batch."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column(0))
        parts = []
        for i, j in slices(offsets, BLOCK):
            t = Tokens(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            first, _, count = t.distinct()
            size = t.end[first] - t.start[first]
            word, place = _runs(size)
            parts.append((t.hash[first], t.kind[first].astype(np.int32), count, size, t.raw[t.start[first][word] + place]))
        if not parts:
            continue
        h, kind, count, size, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
        _, first, inverse = np.unique(_pair_code(h, kind), return_index=True, return_inverse=True)
        word, place = _runs(size[first])
        flat = flat[(np.cumsum(size) - size)[first][word] + place]
        ends = np.concatenate([[0], np.cumsum(size[first])]).astype(np.int64)
        words_ = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())
        n = np.bincount(inverse, weights=count).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(kind[first]), words_, pa.array(n)], names=["hash", "kind", "word", "n"])
    trim()


def _joined(word: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw, offsets = text_bytes(word.cast(pa.large_binary()).view(pa.large_string()))
    return raw, offsets[:-1], offsets[1:]


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256)
    for batch in batches:
        raw, start, end = _joined(batch.column(0))
        n = batch.column(1).to_numpy()
        total += np.bincount(raw, weights=np.repeat(n, end - start), minlength=256)
        total[TERMINATOR] += n.sum()
    yield pa.RecordBatch.from_pydict({"byte": pa.array(np.arange(256), pa.int32()), "n": total.astype(np.int64)})


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers with their first bytes first, then the second ones, and so on: mostly zeros, which compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _of_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class _Counts:
    """Sums of weights by bin and bit, a list for each table: (2 * bin + bit) above the weight, so that one sort groups them."""

    def __init__(self, bits: int) -> None:
        self.shift, self.pending, self.held = np.uint64(63 - bits), [[] for _ in range(MODELS)], 0

    def enter(self, d: Decisions, n: np.ndarray) -> None:
        weight = np.repeat(n.astype(np.uint64), d.n)
        for m, bins in enumerate(d.bins):
            seen = slice(None) if m != 1 else bins >= 0
            x = (bins[seen].astype(np.uint64) << np.uint64(1) | d.bit[seen]) << self.shift | weight[seen]
            self.pending[m].append(x)
            self.held += len(x)

    def _sum(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        x = np.sort(np.concatenate(self.pending[m])) if self.pending[m] else np.zeros(0, np.uint64)
        key = x >> self.shift
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(x) else np.zeros(0, np.int64)
        weight = x & ((np.uint64(1) << self.shift) - np.uint64(1))
        return key[first], np.add.reduceat(weight, first) if len(x) else weight

    def flush(self) -> Iterator[pa.RecordBatch]:
        """The sums, a row for each slice met: steps between its places, and their counts."""
        cut = SLICE_BITS + 1
        for m in range(MODELS):
            key, total = self._sum(m)
            self.pending[m] = []
            part = (key >> np.uint64(cut)).astype(np.int64)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]) if len(part) else np.zeros(1, np.int64)
            local = (key & np.uint64((1 << cut) - 1)).astype(np.int32)
            rows = [(m, int(part[i]), _planes(np.diff(local[i:j], prepend=np.int32(0))), _planes(total[i:j].astype(np.int64))) for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            if rows:
                ms, parts, steps, counts = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ms, pa.int32()), pa.array(parts, pa.int32()), pa.array(steps, pa.binary()), pa.array(counts, pa.binary())], names=["model", "part", "steps", "counts"])
        self.held = 0


def _tabled(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bytes_code, sizes_code), vocabulary, bits = shared.value
        sums = _Counts(bits)
        for batch in batches:
            raw, start, end = _joined(batch.column(1))
            kind, n, h = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_numpy().view(np.uint64)
            for i in range(0, len(n), 20_000):
                own = slice(i, i + 20_000)
                known, place_bits, place, commonest = vocabulary.find(h[own])
                sums.enter(placed(kind[own], known, place_bits, place, sizes_code, bits), n[own])
                # how frequent words are spelled says how new ones are: each counts once there, in its commonest class
                use = np.flatnonzero(~known | ((commonest == kind[own]) & (h[own] != _END_HASH)))
                sums.enter(spelled(raw, start[own][use], end[own][use], kind[own][use], bytes_code, bits), np.where(known[use], 1, n[own][use]))
                if sums.held > HELD:
                    yield from sums.flush()
        yield from sums.flush()
        trim()

    return run


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros(2 << SLICE_BITS, np.int64)
    for steps, counts in zip(table.column("steps").to_pylist(), table.column("counts").to_pylist(), strict=True):
        total[np.cumsum(_of_planes(steps, np.int32))] += _of_planes(counts, np.int64)
    total = total.reshape(-1, 2)
    odds = np.log((total[:, 1] + 0.4) / (total[:, 0] + 0.4))
    inputs = np.clip(np.rint(odds * SCALE), -127, 127).astype(np.int8)
    return pa.table({"model": table.column("model")[:1], "part": table.column("part")[:1], "inputs": pa.array([inputs.tobytes()], pa.binary())})


class Model:
    """Prefix codes of bytes and sizes, quantised tables, token counts, and the counts of known words (None if there are too many to hold)."""

    def __init__(self, code, vocabulary: Vocabulary, tables: np.ndarray, tokens: int, distinct: int, hashes: np.ndarray | None, counts: np.ndarray | None) -> None:
        self.code, self.vocabulary, self.tables, self.tokens, self.distinct, self.hashes, self.counts = code, vocabulary, tables, tokens, distinct, hashes, counts

    def count(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.counts[at].astype(np.int64), 0)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.tokens + self.distinct + 1))

    def costs(self, t: Tokens, first: np.ndarray, inverse: np.ndarray, rows: int) -> np.ndarray:
        """Natural-log cost of each token under the mixed predictors."""
        kind, h = t.kind[first], t.hash[first]
        known, size, place, _ = self.vocabulary.find(h)
        others = np.flatnonzero(~known)
        bits = self.tables.shape[1].bit_length() - 1
        places = _Mixer(lambda i: placed(kind[i], known[i], size[i], place[i], self.code[1], bits), len(h), self.tables, START[0], 1, rows)
        start, end = t.start[first][others], t.end[first][others]
        spelling = _Mixer(lambda i: spelled(t.raw, start[i], end[i], kind[others[i]], self.code[0], bits), len(others), self.tables, START[1], 3, rows)
        other = np.full(len(h), -1)
        other[others] = np.arange(len(others))
        order = np.argsort(t.chunk, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(t.chunk[order])) + 1, [len(order)]])
        out = np.zeros(len(t.row))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = order[a:b]
            word, row = inverse[own], t.row[own]
            out[own] = places.code(word, row)
            word = other[word]
            spell = np.flatnonzero(word >= 0)
            if len(spell):
                out[own[spell]] += spelling.code(word[spell], row[spell])
        return out


class _Mixer:
    """Decisions with the inputs of their predictors, signed by their bits, and weights of each row by gate: whether input `by` is seen."""

    #: Words whose decisions are worked out at once.
    STEP = 16_384

    def __init__(self, of, words: int, tables: np.ndarray, start: np.ndarray, by: int, rows: int) -> None:
        parts = [self._inputs(of(np.arange(i, min(words, i + self.STEP))), tables) for i in range(0, words, self.STEP)]
        self.n = np.concatenate([n for n, _ in parts]) if parts else np.zeros(0, np.int64)
        self.begin = np.cumsum(self.n) - self.n
        self.inputs = np.concatenate([x for _, x in parts]) if parts else np.zeros((0, start.shape[1]), np.float32)
        self.by, self.weights = by, np.tile(start, (rows, 1, 1))

    @staticmethod
    def _inputs(d: Decisions, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sign = (d.bit.astype(np.float32) * 2 - 1) * np.float32(1 / SCALE)
        inputs = np.empty((len(d.bit), len(d.bins)), np.float32)
        for m, bins in enumerate(d.bins):
            np.multiply(tables[m].take(bins, mode="wrap"), sign, out=inputs[:, m])
            if m == 1:
                inputs[bins < 0, m] = 0
        return d.n, inputs

    def code(self, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The costs of these words of their rows (ascending); the rows' weights move along the gradient of their sum."""
        n = self.n[word]
        starts = np.cumsum(n) - n
        at = np.repeat(self.begin[word] - starts, n)
        at += np.arange(len(at))
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        here, begin = row[first], starts[first]  # rows, and where their decisions begin
        size = np.diff(np.append(begin, len(at)))
        x = self.inputs.take(at, axis=0)
        gate = x[:, self.by] != 0
        weights = self.weights[here]
        slot = np.repeat(np.arange(0, 2 * len(here), 2), size)
        slot += gate
        e = np.einsum("ij,ij->i", x, weights.reshape(-1, x.shape[1]).take(slot, axis=0))
        np.exp(np.minimum(np.negative(e, out=e), np.float32(60), out=e), out=e)
        more = 1 + e
        e /= more
        cost = np.add.reduceat(np.log(more, out=more), starts)
        x *= e[:, None]
        all_of = np.add.reduceat(x, begin, axis=0)
        x *= gate[:, None]
        of_seen, seen = np.add.reduceat(x, begin, axis=0), np.add.reduceat(gate, begin, dtype=np.int64)
        step = (RATE / np.sqrt(np.stack([size - seen, seen], axis=1) + 1)).astype(np.float32)
        weights[:, 1] += step[:, 1, None] * of_seen
        weights[:, 0] += step[:, 0, None] * (all_of - of_seen)
        self.weights[here] = weights
        return cost


def runs(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of passages: the run of each token (-1: the first two of a text) and, for each run, its first token, a hash of the two tokens before and one of its own."""
    n = len(t.row)
    place = np.arange(n) - np.searchsorted(t.row, t.row)
    context = np.zeros(n, np.uint64)
    context[2:] = mix(mix(t.hash[:-2]) + t.hash[1:-1])
    inside = place >= 2
    start = inside & ((place == 2) | (context % np.uint64(RUN) == 0))
    first = np.flatnonzero(start)
    run = np.where(inside, np.cumsum(start) - 1, -1)
    at = np.flatnonzero(inside)
    own = mix(t.hash[at] + (at - first[run[at]]).astype(np.uint64) * _ODD)
    return run, first, context[first], mix(np.add.reduceat(own, np.searchsorted(at, first))) if len(first) else own


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, gain) of texts' runs with a known context, (odds, yes, share, cost) each in the order of the text: the log10 probability that passages add."""
    for batch in batches:
        lists = batch.column(1)
        odds, yes, share, cost = (lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in ("odds", "yes", "share", "cost"))
        size = np.diff(lists.offsets.to_numpy())
        begin = np.cumsum(size) - size
        gain, weights, gate = np.zeros(len(size)), np.tile(PASSAGE_START, (len(size), 1, 1)), np.zeros(len(size), np.int64)
        longest = np.argsort(-size, kind="stable")
        ascending = size[longest][::-1]
        for k in range(int(size.max(initial=0))):
            own = longest[: len(size) - int(np.searchsorted(ascending, k, "right"))]  # texts with more than k runs
            at = begin[own] + k
            x, bit = np.stack([odds[at], np.ones(len(at))], axis=1), yes[at]
            w = weights[own, gate[own]]
            z = np.einsum("ij,ij->i", x, w)
            gain[own] += np.where(bit, share[at] + cost[at], 0) - np.logaddexp(0, np.where(bit, -z, z))
            weights[own, gate[own]] = w + PASSAGE_RATE * x * (bit - 1 / (1 + np.exp(-z)))[:, None]
            gate[own] = np.where(bit, 2, 1)
        yield pa.RecordBatch.from_pydict({"row": batch.column(0), "gain": gain / np.log(10)})


def train(texts: DataFrame, scratch: Scratch, known_words: int = KNOWN_WORDS) -> tuple[Model, DataFrame]:
    """The model of these texts (one string column), and the (hash, n) of all their tokens."""
    spark = texts.sparkSession
    gathered = scratch.keep(texts.mapInArrow(_counting, "hash long, kind int, word binary, n long").groupBy("word", "kind").agg(F.first("hash").alias("hash"), F.sum("n").alias("n")), "words")
    counts = scratch.keep(gathered.groupBy("hash").agg(F.sum("n").alias("n"), F.max_by("kind", F.struct("n", "kind")).alias("kind")), "counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    rows = gathered.count()
    histogram = gathered.select("word", "n").mapInArrow(_byte_counts, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    by_byte = np.zeros(256, np.int64)
    for r in histogram:
        by_byte[r["byte"]] = r["n"]
    bits = table_bits(rows)
    tables = np.zeros((MODELS, 1 << bits), np.int8)
    top = counts.where("n > 1").toArrow()
    vocabulary = Vocabulary(top.column("hash").to_numpy().view(np.uint64), top.column("n").to_numpy(), top.column("kind").to_numpy())
    once = distinct - len(vocabulary.hashes)  # as many words are met once as new ones are to be expected
    code = prefix_code(by_byte), prefix_code(np.concatenate([[once], vocabulary.tokens[: SIZES - 1]]))
    shared = spark.sparkContext.broadcast((code, vocabulary, bits))
    dealt = gathered.select("kind", "word", "n", "hash").repartition(max(1, -(-rows // ROWS_PER_TABLE)))
    partial = dealt.mapInArrow(_tabled(shared), "model int, part int, steps binary, counts binary")
    for r in partial.groupBy("model", "part").applyInArrow(_summed, "model int, part int, inputs binary").toLocalIterator():
        tables[r["model"], r["part"] << SLICE_BITS : (r["part"] + 1) << SLICE_BITS] = np.frombuffer(r["inputs"], np.int8)
    hashes = known = None
    if distinct <= known_words:
        held = counts.select("hash", "n").toArrow()
        hashes, known = held.column("hash").to_numpy().view(np.uint64), held.column("n").to_numpy()
        order = np.argsort(hashes)
        hashes, known = hashes[order], known[order].astype(np.uint32 if known.max(initial=0) < 1 << 32 else np.int64)
    return Model(code, vocabulary, tables, int(tokens), int(distinct), hashes, known), counts


#: Rows of texts, of their runs (context, following, cost) and, if known words are too many to hold, of their words (hash, n).
_FIELDS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("n_bytes", pa.int64()), ("base_score", pa.float64()), ("word_score", pa.float64()), ("run", pa.int64()), ("context", pa.int64()), ("following", pa.int64()), ("cost", pa.float32()), ("hash", pa.int64()), ("n", pa.int64())])
SCHEMA = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, n_bytes long, base_score double, word_score double, run long, context long, following long, cost float, hash long, n long"


def _batch(**columns) -> pa.RecordBatch:
    """These columns, and nulls in the others."""
    size = len(columns["row"])
    return pa.RecordBatch.from_pydict({f.name: columns.get(f.name, pa.nulls(size, f.type)) for f in _FIELDS}, schema=_FIELDS)


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, base = shared.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            raw, offsets = text_bytes(batch.column(2))
            for i, j in slices(offsets, BLOCK):
                n = j - i
                t = Tokens(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                first, inverse, _ = t.distinct()
                cost = model.costs(t, first, inverse, n)
                held = batch.column(1).slice(i, n)
                out = {"row": base + np.arange(n), "doc_id": batch.column(0).slice(i, n), "held_out": held, "n_tokens": np.bincount(t.row, minlength=n), "n_bytes": np.diff(offsets[i : j + 1]), "word_score": -np.bincount(t.row, weights=cost, minlength=n) / np.log(10)}
                if model.hashes is not None:
                    c = model.count(t.hash[first])[inverse]
                    out["n_known"], out["base_score"] = np.bincount(t.row, weights=c > 0, minlength=n).astype(np.int64), np.bincount(t.row, weights=model.base(c), minlength=n)
                yield _batch(**out)
                of, begin, context, following = runs(t)
                row = t.row[begin]
                inside = of >= 0
                yield _batch(row=base + row, held_out=held.take(pa.array(row)), run=begin, context=context.view(np.int64), following=following.view(np.int64), cost=np.bincount(of[inside], weights=cost[inside], minlength=len(begin)).astype(np.float32))
                if model.hashes is None:  # (row, word) counts, for the join
                    u, count = np.unique(np.rec.fromarrays([t.row, t.hash], names="r,h"), return_counts=True)
                    yield _batch(row=base + u["r"], hash=u["h"].view(np.int64), n=count.astype(np.int64))
                base += n
        trim()

    return run


def passage_gains(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(row, gain) of texts from their runs (row, run, held_out, context, following, cost): what passages add to the log10 probability.

    Contexts and runs are counted in the runs that are not held out. A frequent one is pre-aggregated before it is shuffled. Its
    occurrences meet one row of a table in each join, so that adaptive execution can split them: it would not, were the counts
    aggregated in the joins' own stages.
    """
    seen = scratch.keep(found.where(~F.col("held_out")).groupBy("context", "following").agg(F.count("*").alias("n")), "runs")
    again = F.when(F.col("n") > 1, F.col("n")).otherwise(0)
    contexts = scratch.keep(seen.groupBy("context").agg(F.sum(again).alias("again"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once")).where("again > 0"), "contexts")
    known = seen.where("n > 1").select("context", "following", F.col("n").cast("double").alias("n"))
    met = found.select("row", "run", "context", "following", "cost").join(contexts, "context").join(known, ["context", "following"], "left")
    odds = F.log((F.col("again") + 0.4) / (F.col("once") + 0.4)).alias("odds")
    share = F.coalesce(F.log(F.col("n") / F.col("again")), F.lit(0.0)).alias("share")
    listed = met.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("run", odds, F.col("n").isNotNull().alias("yes"), share, F.col("cost").cast("double").alias("cost")))).alias("runs"))
    return listed.mapInArrow(_passages, "row long, gain double")


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_col: str = "held_out", known_words: int = KNOWN_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability), bits_per_byte and word_score (without passages) of each text.

    The model is learned from the rows where held_out_col is false.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    model, counts = train(docs.where(~F.col(held_out_col)).select(text), scratch, known_words)
    scratch.drop("words")  # it is in the tables
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(held_out_col).alias("held_out"), text).mapInArrow(_scoring(shared), SCHEMA)
    scored = scratch.keep(rows, "scored")
    rows = scored.where("n_tokens is not null").select("row", "doc_id", "held_out", "n_tokens", "n_known", "n_bytes", "base_score", "word_score")
    rows = rows.join(passage_gains(scored.where("run is not null"), scratch), "row", "left")
    if model.hashes is None:
        found = scored.where("hash is not null").select("row", "hash", F.col("n").alias("times")).join(counts.select("hash", "n"), "hash", "left")
        c = F.coalesce("n", F.lit(0))
        base = found.groupBy("row").agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("n_known"), F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(model.tokens + model.distinct + 1)))).alias("base_score"))
        rows = rows.drop("n_known", "base_score").join(base, "row")
    rows = rows.withColumn("score", F.col("word_score") + F.coalesce("gain", F.lit(0.0)))
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte")
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", bits, "word_score")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_texts(docs.withColumn("held_out", held_out(F.col("doc_id"), 7, 2)))


QUERIES = {"op9_lm_score": op9_lm_score}
ORACLES: dict[str, str] = {}
