"""Quality rules as a bitmask ledger.

Each rule is one boolean expression over measurements of a text. A pass over the documents evaluates every
rule once and stores the measurements and one bit for each failed rule. Policies are versioned sets of rules:
applying one, or asking what each rule does in it, only masks and counts bits and never reads a text again.
Everything is a DataFrame expression; nothing is shuffled but the few sums of `ablations`.

Nulls and edges: a null text measures as an empty one (all zero, so `few_words` fails); a text of any length is
measured whole; rows that repeat are measured each for itself; columns of the input whose names are taken by the
ledger are replaced; an empty table gives an empty ledger. Windows of words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
WINDOW = 8

#: Measurements, in the order in which the ledger holds them.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs", "n_stutters")

#: Name and condition of failure; a rule's bit is its place here, so new rules are only ever appended.
RULES: list[tuple[str, Callable[[Callable[[str], Column]], Column]]] = [
    ("few_words", lambda m: m("n_words") < 20),
    ("repeated_windows", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
    ("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    ("upper_case", lambda m: 2 * m("n_upper") > m("word_chars")),
    ("exclamations", lambda m: 2 * m("n_bangs") > m("n_words")),
    ("stuttering", lambda m: 100 * m("n_stutters") > 30 * m("n_words")),
    ("repeated_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    ("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 15 * m("n_words"))),
]

#: Version: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(name for name, _ in RULES),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once even where body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _joined(hashes: Column, step: int) -> Column:
    """Hashes of spans twice as long: element i with element i + step, as far as there are both."""
    return _let(
        hashes,
        lambda h: F.slice(
            F.zip_with(h, F.slice(h, F.lit(1 + step), F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b)),
            F.lit(1),
            F.greatest(F.size(h) - step, F.lit(0)),
        ),
    )


def _repeated(windows: Column) -> Column:
    """Words that lie in windows of WINDOW words occurring twice or more; windows: their hashes, in order."""

    def covered(starts: Column) -> Column:
        nexts = F.slice(starts, F.lit(2), F.greatest(F.size(starts), F.lit(1)))
        widths = F.zip_with(starts, nexts, lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
        return F.aggregate(widths, F.lit(0).cast("long"), lambda x, y: x + y)

    def twice(pairs: Column) -> Column:
        marked = F.transform(
            pairs,
            lambda x, i: F.when(
                F.coalesce(x["h"] == F.get(pairs, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(pairs, i + 1)["h"], F.lit(False)),
                x["i"],
            ),
        )
        return F.sort_array(F.filter(marked, lambda x: x.isNotNull()))

    def counted(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        some = F.size(F.array_distinct(w)) < F.size(w)
        return F.when(some, _let(_let(pairs, twice), covered)).otherwise(F.lit(0).cast("long"))

    return _let(windows, counted)


def measure(text: Column) -> Column:
    """All measurements of a text as one struct of longs; a null text is an empty one."""
    t = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        def of_hashes(h: Column) -> Column:
            stutters = F.filter(F.zip_with(h, F.slice(h, F.lit(2), F.greatest(F.size(h), F.lit(1))), lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x)
            eight = _joined(_joined(_joined(h, 1), 2), 4)
            return F.struct(F.size(stutters).cast("long").alias("n_stutters"), F.when(F.size(h) >= WINDOW, _repeated(eight)).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"))

        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes).alias("h"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    return F.struct(
        _let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), of_words).alias("w"),
        _let(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)), of_lines).alias("l"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit("!")).cast("long").alias("n_bangs"),
    )


def ledger(docs: DataFrame, text_col: str = "text", field: str | None = None) -> DataFrame:
    """docs with the measurements and `failed`, a long whose bit i is set if rule i of RULES fails; of a field, if text_col is a struct."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {*MEASURES, "failed"}]
    own = docs.select(*rest, measure(F.col(f"`{text_col}`") if field is None else F.col(f"`{text_col}`")[field]).alias("__m"))
    places = {"n_words": "w.n_words", "word_chars": "w.word_chars", "n_repeat_words": "w.h.n_repeat_words", "n_stutters": "w.h.n_stutters", "n_lines": "l.n_lines", "n_dup_lines": "l.n_dup_lines"}
    flat = own.select(*rest, *(F.col(f"__m.{places.get(m, m)}").alias(m) for m in MEASURES))
    return flat.withColumn("failed", _mask(F.col))


def _mask(measured: Callable[[str], Column]) -> Column:
    mask = F.lit(0).cast("long")
    for i, (_, rule) in enumerate(RULES):
        mask = mask.bitwiseOR(F.when(rule(measured), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return mask


def failures(text: Column) -> Column:
    """The ledger's `failed` of a text, for filtering rows whatever their columns."""
    places = {"n_words": ("w", "n_words"), "word_chars": ("w", "word_chars"), "n_repeat_words": ("w", "h", "n_repeat_words"), "n_stutters": ("w", "h", "n_stutters"), "n_lines": ("l", "n_lines"), "n_dup_lines": ("l", "n_dup_lines")}

    def of(m: Column) -> Column:
        def measured(name: str) -> Column:
            out = m
            for part in places.get(name, (name,)):
                out = out[part]
            return out

        return _mask(measured)

    return _let(measure(text), of)


def policy_mask(policy: str | tuple[str, ...]) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(x) for x in (POLICIES[policy] if isinstance(policy, str) else policy))


def passes(policy: str | tuple[str, ...], failed: Column | None = None) -> Column:
    """Whether a ledger row passes a policy: none of the policy's bits is set."""
    failed = F.col("failed") if failed is None else failed
    return failed.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def ablations(rows: DataFrame, policy: str | tuple[str, ...] = "v1") -> DataFrame:
    """For each rule of a policy: how many documents fail it, and how many would be kept without it alone.

    One aggregation over the bits of the ledger; rows (rule, n_failed, n_only), all zero for an empty ledger.
    """
    chosen = policy_mask(policy)
    held = F.col("failed").bitwiseAND(F.lit(chosen).cast("long"))
    used = [(i, name) for i, (name, _) in enumerate(RULES) if chosen >> i & 1]
    sums = rows.agg(*(F.struct(F.count_if(held.bitwiseAND(F.lit(1 << i).cast("long")) != 0).alias("n_failed"), F.count_if(held == 1 << i).alias("n_only")).alias(name) for i, name in used))
    return sums.select(F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.col(name)["n_failed"].alias("n_failed"), F.col(name)["n_only"].alias("n_only")) for _, name in used))).alias("x")).select("x.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = [m for m in MEASURES if m not in first]
    return rows.select("doc_id", *first, (~passes("base")).alias("base_failed"), passes("v1").alias("kept"), *more, "failed")


_GAP = r"'[\x20\x09-\x0D]+'"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, {_GAP}), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, {_GAP}, '', 'g') <> '') AS ls FROM d),
p AS (SELECT rid, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(ws[i:i + 7], ' ')) AS n FROM p),
s AS (SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS c FROM g WHERE n > 1),
r AS (SELECT rid, sum(c) AS c FROM s GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.c, 0)::BIGINT AS n_repeat_words,
        len(ls)::BIGINT AS n_lines, len(regexp_extract_all(t, '\p{{Lu}}'))::BIGINT AS n_upper,
        len(regexp_extract_all(t, '!'))::BIGINT AS n_bangs,
        len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_stutters
      FROM w LEFT JOIN r USING (rid)),
f AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_upper > word_chars THEN 8 ELSE 0 END
        + CASE WHEN 2 * n_bangs > n_words THEN 16 ELSE 0 END + CASE WHEN 100 * n_stutters > 30 * n_words THEN 32 ELSE 0 END
        + CASE WHEN 2 * n_dup_lines > n_lines THEN 64 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 128 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept,
  n_lines, n_upper, n_bangs, n_stutters, failed FROM f
"""

QUERIES = {"op4_quality_rules": op4_quality_rules}
ORACLES = {"op4_quality_rules": SQL}
