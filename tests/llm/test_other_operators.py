import itertools
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cadenza.llm import collision_search, transcripts, url_filter
from cadenza.llm._shared import Scratch

# --- vectors


def test_search_against_brute_force(spark):
    rng = np.random.RandomState(4)
    vectors = rng.randn(3000, 16) * rng.rand(3000, 1) * 3
    vectors[500:520] = vectors[40]  # ties
    rows = [(i, [float(x) for x in v], "s") for i, v in enumerate(vectors)]
    odd = [(9000, None, ""), (9020, [0.0] * 16, ""), (9040, [1.0] * 15, ""), (9060, [float("nan")] + [1.0] * 15, ""), (9080, [None] + [1.0] * 15, ""), (None, [1.0] * 16, ""), (9100, [float("inf")] * 16, "")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in collision_search.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    hits = 0
    for q, found in got.items():
        found.sort()
        scores = vectors @ vectors[q]
        assert [k for k, _, _ in found] == list(range(1, 21)) and q not in {v for _, v, _ in found}
        assert all(math.isclose(s, scores[v], rel_tol=1e-12, abs_tol=1e-12) for _, v, s in found)
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        scores[q] = -np.inf
        hits += len({v for _, v, _ in found} & set(np.lexsort((np.arange(3000), -np.round(scores, 10)))[:20].tolist()))
    assert hits / (20 * len(got)) >= 0.9


def test_search_small_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>")
    got = [(r["rank"], r.vec_id) for r in collision_search.nearest(few, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 1), (3, 2)]
    assert collision_search.nearest(few.limit(0), F.lit(True)).count() == 0


def test_search_of_random_vectors_verifies_few(spark):
    vectors = np.random.RandomState(6).randn(4096, 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = collision_search.nearest(df, F.col("vec_id") % 20 == 0).collect()
    scores = vectors[::20] @ vectors.T
    scores[np.arange(len(scores)), np.arange(0, 4096, 20)] = -np.inf
    true = np.argsort(-scores, axis=1)[:, :20]
    hits = sum(r.vec_id in true[r.query_id // 20] for r in found)
    assert len(found) == 20 * len(scores) and hits / len(found) >= 0.9
    assert np.median([r.verified for r in found]) < 0.12 * 4096


def test_search_with_repeated_ids_and_several_lengths(spark):
    rng = np.random.RandomState(2)
    rows = [(0, rng.randn(4)), (0, rng.randn(4)), (20, rng.randn(6))] + [(i, rng.randn(4)) for i in range(21, 40)] + [(i, rng.randn(6)) for i in range(61, 65)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = {}
    for r in collision_search.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault((r.query_id, r.query_row), []).append((r["rank"], r.vec_id, r.score))
    want = []
    for k, (q, v) in enumerate(rows):
        if q % 20 == 0:
            near = sorted((-float((u * v).sum()), i) for m, (i, u) in enumerate(rows) if m != k and len(u) == len(v))[:20]
            want.append((q, [(n + 1, i, -s) for n, (s, i) in enumerate(near)]))
    assert sorted((q, sorted(x)) for (q, _), x in got.items()) == sorted(want) and len(got) == 3
    assert sorted(len(x) for x in got.values()) == [4, 20, 20]


# --- URLs

URLS = [
    "https://A.Example.NET/en/1", "http://b.net/x?y#z", "https://net/", "https://net", "https://example.net/en", "https://x.example.com/de/2", "https://x.example.com/fr/2",
    "ftp://Q.org/fr/9#a/b", "no scheme", "", None, "https://", "https://a.org/fr/?x=://y", "https://notexample.net/en/", "https://é.org/en/ü", "https://ÀB.net/", "https://b.net/x?y#z",
]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = next((rest[:i] for i, c in enumerate(rest) if c in "/?#"), rest)
    path = rest[len(host) :]
    path = next((path[:i] for i, c in enumerate(path) if c in "?#"), path)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(v, h + p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[1]), default=(None, None))


def brute_verdicts(urls, order=url_filter.ORDER):
    parts = [split(u) for u in urls]
    rules = [rule_of(*p) for p in parts]
    texts = ["".join("0" if c in "123456789" else c for c in h + p) for h, p in parts]
    pad = url_filter.START * order
    counts = {side: Counter() for side in ("block", "allow")}
    for text, (verdict, _) in zip(texts, rules):
        if verdict:
            for i in range(len(text)):
                gram = (pad + text)[i : i + order + 1]
                for k in range(order + 1):
                    counts[verdict]["c", gram[order - k :]] += 1
                    counts[verdict]["t", k, gram[order - k : order]] += 1

    def probability(side, gram):
        p = 1 / url_filter.ALPHABET
        for k in range(order + 1):
            p = (counts[side]["c", gram[order - k :]] + url_filter.LOWER_ORDER * p) / (counts[side]["t", k, gram[order - k : order]] + url_filter.LOWER_ORDER)
        return p

    scores = []
    for text in texts:
        grams = [(pad + text)[i : i + order + 1] for i in range(len(text))]
        scores.append(round(sum(round(math.log(probability("block", g)) - math.log(probability("allow", g)), 9) for g in grams) / len(grams), 3) if grams else None)
    labelled = [(s, v) for s, (v, _) in zip(scores, rules) if v and s is not None]
    bad, good = sum(v == "block" for _, v in labelled), sum(v == "allow" for _, v in labelled)
    threshold = None
    if bad and good:
        threshold = max((sum(s > t and v == "block" for s, v in labelled) / bad + sum(s <= t and v == "allow" for s, v in labelled) / good, t) for t in {s for s, _ in labelled})[1]
    model = ["block" if threshold is not None and s is not None and s > threshold else "allow" for s in scores]
    return [(u, h, p, r, v or m) for u, (h, p), (v, r), m in zip(urls, parts, rules, model)]


def test_url_rules_and_model_against_brute_force(spark):
    rng = np.random.RandomState(3)
    made = [f"https://{rng.choice(['a', 'shop', 'm.win', 'blog'])}.{rng.choice(['net', 'org', 'example.net', 'example.com'])}/{rng.choice(['en', 'de', 'fr'])}/{rng.choice(['cheap', 'read', 'news'])}{rng.randint(999)}" for _ in range(150)]
    urls = URLS + made
    df = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, score int")
    got = [(r.url, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).orderBy("page_id").collect()]
    assert got == brute_verdicts(urls)
    assert {v for *_, r, v in got if r is None} == {"allow", "block"}


def test_a_very_long_url(spark):
    urls = [*URLS, "https://shop.net/" + "cheap/" * 8000, "https://example.net/en/" + "read/" * 8000, "https://b.xyz/" + "x" * 20_000 + "?" + "y" * 20_000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [(r.url, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).orderBy("page_id").collect()]
    assert got == brute_verdicts(urls)


def test_urls_without_a_class_or_rows(spark):
    df = spark.createDataFrame([(1, "https://a.net/"), (2, "https://b.xyz/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(df).orderBy("page_id").collect()] == ["block", "allow"]
    assert url_filter.judge(df.limit(0)).count() == 0


# --- transcripts


def brute_path(emit, step):
    best = max(itertools.product(range(3), repeat=len(emit)), key=lambda p: step[3][p[0]] + sum(step[a][b] for a, b in zip(p, p[1:])) + sum(e[r] for e, r in zip(emit, p)))
    return list(best)


def score_of(path, emit, step):
    return step[3][path[0]] + sum(step[a][b] for a, b in zip(path, path[1:])) + sum(e[r] for e, r in zip(emit, path))


def test_viterbi_in_blocks_equals_brute_force():
    rng = np.random.RandomState(8)
    step = rng.randint(-900, 0, (4, 3)).astype(np.int64)
    for n in (1, 2, 5, 7):
        emit = rng.randint(-900, 0, (n, 3)).astype(np.int64)
        want = score_of(brute_path(emit, step), emit, step)
        assert score_of(transcripts.viterbi(emit, step, 3), emit, step) == want
        for cut in range(1, n):
            blocks = []
            for part in (emit[:cut], emit[cut:]):
                m = step + part[0]
                for e in part[1:]:
                    m = (m[:, :, None] + step[None, :-1, :]).max(axis=1) + e
                blocks.append(m.ravel().tolist())
            (a, b), (c, d) = transcripts.chained(blocks)
            path = transcripts.viterbi(emit[:cut], step, a, b) + transcripts.viterbi(emit[cut:], step, c, d)
            assert a == 3 and c == b and score_of(path, emit, step) == want


def conversations(spark):
    rows = []
    for c in range(60):
        rows.append((c, 0, "system", "You answer briefly."))
        for t in range(1, 7, 2):
            rows += [(c, t, "user", f"What is number {t}?"), (c, t + 1, "assistant", "It is a long answer. " * 20 + "\nWith a second line.")]
    odd = [(100, 0, None, None), (100, 1, "user", ""), (101, None, "user", "Hi?"), (None, 0, "user", "Who?"), (102, 0, "robot", "?"), (103, 0, None, "User: What is it?\n### Assistant: A thing.\r\nMore. \n[User]: Thanks"), (0, 1, "user", "What is number 1?")]
    return spark.createDataFrame([(*r, "clash") for r in rows + odd], "conv_id long, turn long, role string, text string, body string").withColumn("held_out", F.coalesce(F.col("conv_id") % 5 == 0, F.lit(False)))


def test_roles_and_rendering(spark, monkeypatch):
    whole = transcripts.parse(conversations(spark), Scratch(spark, "test")).collect()
    known = [r for r in whole if r.held_out and r.role in transcripts.ROLES and r.conv_id < 60]
    assert len(known) > 70 and sum(r.role == r.role_pred for r in known) / len(known) > 0.95
    cut = sorted((r.part, r.role_pred, r.rendered) for r in whole if r.conv_id == 103)
    assert [(p, x) for p, x, _ in cut] == [(0, "user"), (1, "assistant"), (2, "user")]
    assert cut[1][2] == "<|assistant|>\nA thing.\nMore.<|end|>\n"
    assert len([r for r in whole if r.conv_id == 100]) == 2 and len([r for r in whole if r.conv_id is None]) == 1
    monkeypatch.setattr(transcripts, "BLOCK", 2)
    blocks = transcripts.parse(conversations(spark), Scratch(spark, "test")).collect()
    order = lambda rows: sorted((repr(r.conv_id), repr(r.turn), r.part, r.role_pred, r.rendered) for r in rows)
    assert order(blocks) == order(whole)


def brute_segments(text):
    text = text or ""
    starts = [m.start() for m in re.finditer(transcripts.MARKER_LINE, text)]
    out = [(None, text[: starts[0]])] if starts and text[: starts[0]].strip(" ") else []
    for a, b in zip(starts, [*starts[1:], len(text)]):
        end = re.compile(transcripts.MARKER_LINE).match(text, a).end()
        out.append((text[a:end].lower(), text[end:b]))
    return out if starts else [(None, text)]


def brute_features(marker, body, turn, part):
    kind = "none"
    if marker:
        kind = next((role for role, words in transcripts.MARKERS if re.search(rf"(?i)^[^a-z]*(?:{words})[^a-z]*$", marker)), "none")
    lines = min(8, sum(bool(line.strip()) for line in body.split("\n")))
    return {"marker": kind, "size": str(math.floor(math.log2(len(body) + 1) * 2)), "lines": str(lines), "asks": str(bool(re.search(r"\?[ \t]*(?:\n|$)", body))).lower(), "opens": str((turn or 0) == 0 and part == 0).lower()}


def brute_roles(rows):
    """Rows (conv, turn, role, text, held_out, order among equal turns), in order, to [(conv, turn, place, part, role_pred, body)]."""
    seen, steps, convs = Counter(), Counter(), {}
    for conv, turn, role, text, held in rows:
        cut = brute_segments(text)
        own = [(turn, part, role if len(cut) == 1 else None, body, brute_features(marker, body, turn, part)) for part, (marker, body) in enumerate(cut)]
        convs.setdefault(conv, (held, []))[1].extend(own)
    for held, items in convs.values():
        for k, (_, _, role, _, features) in enumerate(items):
            if held or role not in transcripts.ROLES:
                continue
            seen.update((role, f, v) for f, v in features.items())
            if k == 0 or items[k - 1][2] in transcripts.ROLES:
                steps[items[k - 1][2] if k else None, role] += 1
    for role in transcripts.ROLES:
        seen[role, "marker", role] += transcripts.MARKER_PRIOR
    log = lambda n, total, kinds: round(transcripts.SCALE * math.log((n + 1) / (total + kinds)))
    values = {f: {v for _, g, v in seen if g == f} for f in transcripts.FEATURES}

    def emitted(role, features):
        return sum(log(seen[role, f, v], sum(seen[role, f, x] for x in values[f]), len(values[f]) + 1) for f, v in features.items() if v in values[f])

    def stepped(a, b):
        return log(steps[a, b], sum(steps[a, x] for x in transcripts.ROLES), 3)

    out = []
    for conv, (_, items) in convs.items():
        paths = {r: (stepped(None, r) + emitted(r, items[0][4]), [r]) for r in transcripts.ROLES}
        for item in items[1:]:
            best = {r: max((paths[a][0] + stepped(a, r), -k) for k, a in enumerate(transcripts.ROLES)) for r in transcripts.ROLES}
            paths = {r: (best[r][0] + emitted(r, item[4]), [*paths[transcripts.ROLES[-best[r][1]]][1], r]) for r in transcripts.ROLES}
        path = max(((s, -k) for k, (s, _) in enumerate(paths.values())))[1]
        for place, (item, role) in enumerate(zip(items, paths[transcripts.ROLES[-path]][1])):
            out.append((conv, item[0], place, item[1], role, item[3]))
    return out


def raw_transcripts():
    rng = np.random.RandomState(12)
    rows, marks = [], ["User: ", "### Assistant:\n", "[user] ", "<|assistant|>\n", "System: "]
    for c in range(40):
        for t in range(rng.randint(1, 6)):
            role = transcripts.ROLES[1 + t % 2]
            text = "Zebra? " * rng.randint(1, 4) if role == "user" else "An apple. " * rng.randint(3, 30)
            if rng.rand() < 0.4:  # a raw transcript in one row; its bodies aren't in alphabetic order
                text = "\n".join(marks[rng.randint(5)] + rng.choice(["zz why?", "aa \x01 so \x02 it", "mm is\nso. " * 5, "\x03c"]) for _ in range(rng.randint(2, 9)))
            rows.append((c, t, role, text, c % 5 == 0))
    rows += [(50, 0, None, "\n".join(f"{marks[i % 2]}{9 - i % 10} {'x' * 5000}" for i in range(200)), False)]  # a row of a megabyte
    rows += [(51, 0, None, "User: b\nAssistant: a", False)] * 2 + [(None, None, "user", "Hi?", False), (None, 3, None, None, False), (52, 0, "user", "", False)]
    return rows


def test_whole_query_against_brute_force(spark, monkeypatch):
    rows = raw_transcripts()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, held_out boolean").repartition(3)
    want = []
    for *place, role, body in brute_roles(rows):
        clean = re.sub(r"[ \t]+(?=\n|$)", "", re.sub(r"\r\n?", "\n", body)).strip(" \t\n\x0b\f\r")
        want.append(repr((*place, role, f"<|{role}|>\n{clean}<|end|>\n")))
    for block in (4096, 3):
        monkeypatch.setattr(transcripts, "BLOCK", block)
        found = transcripts.parse(df, Scratch(spark, "test")).collect()
        assert sorted(repr((r.conv_id, r.turn, r.place, r.part, r.role_pred, r.rendered)) for r in found) == sorted(want)


def test_equal_turns_stay_whole(spark):
    rows = [(1, 0, None, f"User: {c}1?\nAssistant: {c}2.\nUser: {c}3?", False) for c in "cabcc"]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, held_out boolean")
    found = sorted(transcripts.parse(df, Scratch(spark, "test")).collect(), key=lambda r: r.place)
    said = [r.rendered.split("\n")[1] for r in found]
    assert [r.part for r in found] == [0, 1, 2] * 5
    assert all(len({x[0] for x in said[i : i + 3]}) == 1 for i in range(0, 15, 3))
    assert [r.role_pred for r in found] == ["user", "assistant", "user"] * 5


def test_no_conversations(spark):
    assert transcripts.parse(conversations(spark).limit(0), Scratch(spark, "test")).count() == 0


def test_markers_without_a_colon(spark):
    texts = {
        "### User\nHi\n\n### Assistant\nHello\n": ["### user", "### assistant"],
        "<|user|>\nHi\n<|assistant|> Hello\n<|q|>So?": ["<|user|>", "<|assistant|>", "<|q|>"],
        "[user] Hi\n[assistant] Hello": ["[user]", "[assistant]"],
        "**User**\r\nHi\r\n**Assistant**\r\nHello": ["**user**", "**assistant**"],
        "Human\nHi\nAI\nHello": ["human", "ai"],
        "Q: Hi\nA: Hello": ["q:", "a:"],
        "The user\nasked\n# Context of it\n**Answer** the question\n[a] one\n[user](there)\nAnswer": [None],
        "Agent": [None],
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: [p.marker and p.marker.strip() for p in r.s] for r in df.select("i", transcripts.segments(F.col("text")).alias("s")).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())
    rows = df.select(F.col("i").cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), "text", F.lit(True).alias("held_out"))
    roles = {}
    for r in sorted(transcripts.parse(rows, Scratch(spark, "test")).collect(), key=lambda r: (r.conv_id, r.part)):
        roles.setdefault(r.conv_id, []).append(r.role_pred)
    assert all(roles[i][:2] == ["user", "assistant"] for i in range(6))


def test_separators_in_the_text_stay(spark):
    texts = ["User: a\u0002b\u0001c\u0003d\u0003a\u0003ca", "x\u0001y\u0002z", "\u0003b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [[p.body for p in r.s] for r in df.select("i", transcripts.segments(F.col("text")).alias("s")).orderBy("i").collect()]
    assert got == [[texts[0][6:]], [texts[1]], [texts[2]]]
