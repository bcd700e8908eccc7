"""Language identification with string kernels.

A text is represented by the set of its character n-grams (2 to 4 bytes of the lower-cased text: a blended
spectrum with presence values). The kernel of two texts is the number of common n-grams over the geometric mean
of both set sizes. Nyström landmarks, drawn evenly over the languages, give every text one coordinate for each
landmark (whitened by the inverse root of the landmarks' own kernel), and one-versus-rest kernel ridge regression
on them has a closed solution. A batch of texts is scored by two products of matrices: presence by landmarks,
then coordinates by weights.

Training uses a bounded sample of every language: TRAIN_PER_LANG texts with the smallest hashes of doc_id, of which
LANDMARKS_PER_LANG are landmarks; with more than LANDMARKS / LANDMARKS_PER_LANG languages each has fewer, one at least.
The model (a matrix of 4 x LANDMARKS x 2**GRAM_BITS bytes at most, more only beyond LANDMARKS languages) is broadcast;
the sample's n-grams are held by the driver and grow with the languages. Every text is scored whole.

Nulls and edges: a null text or one without a letter is `und` with score 0; rows with a null language are never
learned from; with no labelled row every text is `und`; repeated rows are each scored; result columns replace
input columns of the same name; an empty table gives an empty result. A text of very many different n-grams fills the
2**GRAM_BITS bins; its kernel is then close to that of any text, but it is still told apart by the landmarks' own n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from cadenza.llm._shared import LOWER, sequence_bytes, ship

GRAMS = (2, 3, 4)
GRAM_BITS = 18
TRAIN_PER_LANG, LANDMARKS_PER_LANG, LANDMARKS = 300, 24, 64 * 24
#: Texts that fitting takes at once, and entries of the presence rows of a product.
STEP, PRESENT = 1024, 3 << 20
OVERSAMPLE = 4
RIDGE = 1e-3


def grams(raw: np.ndarray) -> np.ndarray:
    """The distinct n-grams of a text as sorted bins of a 2**GRAM_BITS space. Digits and ASCII punctuation count as spaces."""
    seen = np.zeros(1 << GRAM_BITS, bool)
    _mark(seen, raw)
    return np.flatnonzero(seen)


_CLASS = LOWER.copy()
_CLASS[:128][[not (97 <= x <= 122) for x in LOWER[:128]]] = 32


def _mark(seen: np.ndarray, raw: np.ndarray) -> None:
    b = _CLASS[raw]
    b = np.concatenate([[np.uint8(32)], b, [np.uint8(32)]])
    if len(b) > 1:  # runs of spaces are one space
        b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
    code = b.astype(np.uint32)
    for n in range(2, max(GRAMS) + 1):
        if len(b) < n:
            break
        code = (code[:-1] * np.uint32(257)) ^ b[n - 1 :]
        if n in GRAMS:
            h = (code + np.uint32(n)) * np.uint32(2654435761)
            seen[h >> np.uint32(32 - GRAM_BITS)] = True


class Model:
    """Landmarks and weights. scores(sets) gives a row of decision values for each set of n-grams."""

    def __init__(self, langs: list[str], landmarks: list[np.ndarray], mapping: np.ndarray, weights: np.ndarray) -> None:
        self.langs, self.mapping, self.weights = langs, mapping, weights
        used = np.unique(np.concatenate(landmarks))
        self.row = np.zeros(1 << GRAM_BITS, np.int32)  # row of each n-gram's landmark values; 0: in no landmark
        self.row[used] = np.arange(1, len(used) + 1)
        self.values = np.zeros((len(used) + 1, len(landmarks)), np.float32)
        for k, x in enumerate(landmarks):
            self.values[self.row[x], k] = 1 / np.sqrt(max(1, len(x)))

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Products of presence rows by the landmark matrix, as many texts at a time as PRESENT entries allow."""
        out = np.empty((len(sets), self.values.shape[1]))
        most = max(1, PRESENT // len(self.values))
        for i in range(0, len(sets), most):
            own = sets[i : i + most]
            sizes = np.array([len(x) for x in own], np.int64)
            present = np.zeros((len(own), len(self.values)), np.float32)
            present[np.repeat(np.arange(len(own)), sizes), self.row[np.concatenate(own)]] = 1
            present[:, 0] = 0  # n-grams of no landmark
            out[i : i + most] = (present @ self.values) / np.sqrt(np.maximum(sizes, 1))[:, None]
        return out

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        z = self.kernel(sets) @ self.mapping
        return np.concatenate([z, np.ones((len(z), 1))], axis=1) @ self.weights


    def excess(self, f: np.ndarray) -> np.ndarray:
        """How far decision values lie from the mean of all targets (0: nothing known of the text) to that of the class (1); 1 if there is one class only."""
        mean = 2 / len(self.langs) - 1
        return (f - mean) / (1 - mean) if mean < 1 else np.ones_like(f)


def fit(sets: list[np.ndarray], langs: list[str], ridge: float = RIDGE) -> Model | None:
    """n-gram sets in a fixed order; the first of each language (LANDMARKS_PER_LANG, or its share of LANDMARKS) are the landmarks. None without sets."""
    if not sets:
        return None
    names = sorted(set(langs))
    most = max(1, min(LANDMARKS_PER_LANG, LANDMARKS // len(names)))
    seen: dict[str, int] = dict.fromkeys(names, 0)
    chosen = []
    for i, lang in enumerate(langs):
        seen[lang] += 1
        if seen[lang] <= most and len(sets[i]):
            chosen.append(i)
    if not chosen:
        return None
    model = Model(names, [sets[i] for i in chosen], np.eye(len(chosen)), np.zeros((len(chosen) + 1, len(names))))
    values, vectors = np.linalg.eigh(model.kernel([sets[i] for i in chosen]))
    keep = values > 1e-8 * values.max()
    model.mapping = vectors[:, keep] / np.sqrt(values[keep])  # Nyström: K_mm to the power -1/2
    class_of = {lang: k for k, lang in enumerate(names)}
    own = np.array([class_of[x] for x in langs])
    share = 1.0 / np.bincount(own)  # each language weighs the same
    left, right = ridge * np.eye(model.mapping.shape[1] + 1), np.zeros((model.mapping.shape[1] + 1, len(names)))
    for i in range(0, len(sets), STEP):
        z = model.kernel(sets[i : i + STEP]) @ model.mapping
        z = np.concatenate([z, np.ones((len(z), 1))], axis=1)
        of = own[i : i + STEP]
        target = np.where(of[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
        size = share[of][:, None]
        left += z.T @ (size * z)
        right += z.T @ (size * target)
    model.weights = np.linalg.solve(left, right)
    return model


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, grams): n-gram sets of TRAIN_PER_LANG whole texts of each language, those with the smallest hashes, in that order.

    Languages are counted first; a cut on the hashes that leaves about OVERSAMPLE times the wanted rows of each then
    goes before anything is shuffled or sent on.
    """
    ship(docs.sparkSession)
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(text_col).alias("text"))
    counts = known.groupBy("lang").count().collect()
    cuts = [(r["lang"], min((1 << 63) - 1, int(-(1 << 63) + min(1.0, OVERSAMPLE * TRAIN_PER_LANG / r["count"]) * (1 << 64)))) for r in counts]
    cut = F.broadcast(docs.sparkSession.createDataFrame(cuts, "lang string, cut long"))  # a row for each language
    rows = known.join(cut, "lang").where(F.col("h") <= F.col("cut")).select("lang", "h", "text")
    sets = rows.mapInArrow(_gram_sets, "lang string, h long, grams binary")
    ranked = sets.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("h", "grams")))
    return ranked.where(F.col("r") <= TRAIN_PER_LANG).orderBy("lang", "r").select("lang", "grams")


def _gram_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [grams(raw[offsets[k] : offsets[k + 1]]).astype(np.int32).tobytes() for _, _, raw, offsets in sequence_bytes(batch, "text") for k in range(len(offsets) - 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], names=["lang", "h", "grams"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    sample = training_sample(docs, id_col, text_col, lang_col).toArrow()
    return fit([np.frombuffer(x, np.int32) for x in sample.column("grams").to_pylist()], sample.column("lang").to_pylist())


_CHANCE = 4.0


def _predict(model: Model | None, text_col: str, names: list[str], outputs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            langs, score, decision = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for i, j, raw, offsets in sequence_bytes(batch, text_col):
                own = [k for k in range(j - i) if letters[i + k]]
                if model is None or not own:
                    continue
                f = model.scores([grams(raw[offsets[k] : offsets[k + 1]]) for k in own])
                best = f.argmax(axis=1)
                at = np.array(own) + i
                langs[at] = np.array(model.langs, object)[best]
                decision[at] = model.excess(f[np.arange(len(own)), best])
                e = np.exp(_CHANCE * (f - f.max(axis=1, keepdims=True)))
                score[at] = (e / e.sum(axis=1, keepdims=True))[np.arange(len(own)), best]
            rest = [batch.column(k) for k, f in enumerate(batch.schema) if f.name not in outputs]
            made = [pa.array(langs, pa.string()), pa.array(score), pa.array(decision)]
            yield pa.RecordBatch.from_arrays([*rest, *made[: len(outputs)]], names=names)

    return run


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score", decision_out: str | None = None) -> DataFrame:
    """docs with the predicted language (a learned one, or `und`) and its score (0 to 1: the normalised margin of the winner).

    decision_out, if named, is Model.excess of the winner, 0 for `und`. Unlike the score it doesn't depend on how many
    languages there are.
    """
    ship(docs.sparkSession)
    made = [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType()), *([T.StructField(decision_out, T.DoubleType())] if decision_out else [])]
    outputs = [f.name for f in made]
    out = T.StructType([*(f for f in docs.schema.fields if f.name not in outputs), *made])
    return docs.mapInArrow(_predict(model, text_col, out.fieldNames(), outputs), out)


def held_out(id_col: Column, parts: int, rest: int) -> Column:
    """Whether crc32 of an id as text leaves this remainder; null ids are not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == rest, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id"), 5, 0))
    model = learn(docs.where(~F.col("held_out")))
    return predict(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op5_language_id": op5_language_id}
ORACLES: dict[str, str] = {}
