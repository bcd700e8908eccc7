import random
from collections import Counter, defaultdict

from edge import documents, empty, frame, lowered, prose, tokens, vocabulary

from cadenza.llm import near_dedup


def brute(rows, size):
    sets = []
    for _, text in rows:
        w = tokens(lowered(text))
        sets.append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in index[g])
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[top(i)] = top(j)
        for g in s:
            index[g].append(i)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[top(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in least[top(i)] if d is not None]
        component = None if doc is None else min(ids)
        out.append((doc, len(sets[i]), component, doc is None or doc == component))
    return sorted(out, key=repr)


def found(df, size):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, size=size).collect()), key=repr)


def test_edge_cases_against_brute_force(spark):
    rows = [(r[0], r[1]) for r in documents()]
    assert found(frame(spark), 4) == brute(rows, 4)
    assert found(frame(spark, clash=True), 5) == brute(rows, 5)


def test_families_of_near_copies_against_brute_force(spark):
    """Copies with one to many edits: chains, links at the threshold, and members that are close but not linked."""
    rng = random.Random(9)
    words = vocabulary(rng, ["ka", "lo", "mi", "ne", "ru", "sa"], 3000)
    rows = []
    for family in range(4):
        base = prose(rng, 120, words).split(" ")
        for k in range(60):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((family * 1000 + k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 4) == brute(rows, 4)


def test_blocks_find_what_the_first_round_misses(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", 3)
    rng = random.Random(2)
    words = vocabulary(rng, ["ka", "lo", "mi", "ne"], 2000)
    shared = prose(rng, 60, words)
    rows = []
    for k in range(40):  # half the text is shared by all; pairs of documents are near copies
        own = prose(random.Random(k // 2), 55, words).split(" ")
        own[k % 2] = "edit"
        rows.append((k, shared + " " + " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 4) == brute(rows, 4)


def test_empty_table(spark):
    assert found(empty(spark), 4) == []
    assert near_dedup.drop_near_duplicates(empty(spark)).count() == 0


def test_an_id_with_two_texts_loses_only_the_copy(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (2, b), (3, None), (3, None)], "doc_id long, text string")
    assert sorted(near_dedup.drop_near_duplicates(df).collect(), key=repr) == sorted([(1, a), (2, b), (3, None)], key=repr)


def test_drop_keeps_one_row_of_each_group_with_its_columns(spark):
    df = frame(spark, clash=True)
    got = near_dedup.drop_near_duplicates(df)
    assert got.columns == df.columns
    ids = sorted((r.doc_id for r in got.collect()), key=repr)
    kept = sorted({d for d, _, _, k in brute([(r[0], r[1]) for r in documents()], 5) if k}, key=repr)
    assert ids == kept and 105 not in ids and None in ids
