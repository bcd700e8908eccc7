"""Documents with every awkward case, and brute-force helpers."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators give to results.
CLASHING = {"score": 7.0, "kept": True, "failed": 3, "lang_pred": "x", "ids": "y", "bucket": 9, "n_tokens": 5, "key": "k", "root": 1, "held_out": False, "row": 2, "n": 4, "h": 1, "verdict": "v", "host": "w"}


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def vocabulary(rng, parts, n):
    return sorted({"".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)})


def documents():
    rng = random.Random(5)
    en, de = vocabulary(rng, ["th", "ing", "er", "and", "on", "re", "ou"], 400), vocabulary(rng, ["sch", "ung", "ein", "ü", "keit", "ch", "ver"], 400)
    rows = [(i, prose(rng, rng.randint(30, 300), en if i % 3 else de), "en" if i % 3 else "de", "s", 1) for i in range(90)]
    base = rows[4][1].split(" ")
    near = [" ".join(base[:k] + ["zzz"] + base[k + 1 :]) for k in (3, len(base) // 2)]
    rows += [(100, None, "en", None, None), (101, "", None, "s", 0), (102, " \n\t ", "en", "s", 3), (103, "one two", "en", "s", 7), (104, "12 34 !!", None, "s", 8)]
    rows += [(105, rows[4][1], "en", "t", 1), (105, rows[4][1], "en", "t", 1), (106, near[0], "en", "t", 1), (107, near[1], None, "t", 1), (108, rows[4][1].upper(), "en", "t", 1)]
    rows += [(109, prose(rng, 60_000, en), "en", "long", 1), (110, "x" * 200_000, "en", "long", 1), (None, rows[7][1], "en", "s", 1), (112, "a\x1cb c  d İ ﬁ ǅ é", "en", "s", 1)]
    return rows


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def frame(spark, clash=False):
    df = spark.createDataFrame(documents(), SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({k: F.lit(v) for k, v in CLASHING.items()})
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
