import random
from collections import Counter, defaultdict

import pyarrow as pa
import re

from cohortlift.llm.components import components
from cohortlift.llm.ngram_join import jaccard_components
from cohortlift.llm.words import WORD_PATTERN, shingle_sets, text_slices


def sets_of(rows, width):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    found = {}
    for doc_id, text in rows:
        words = re.findall(WORD_PATTERN, (text or "").translate(fold))
        grams = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        found[doc_id] = frozenset(grams)
    return found


def brute_force(rows, width, num, den):
    sets = sets_of(rows, width)
    links = defaultdict(set)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and den * both >= num * len(sets[a] | sets[b]):
                links[a].add(b), links[b].add(a)
    root = {}
    for start in sorted(sets):
        waiting = [start]
        while waiting:
            at = waiting.pop()
            if at not in root:
                root[at] = start
                waiting += links[at]
    return {d: (len(sets[d]), root[d]) for d in sets}


def edited(words, times, rng):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"n{rng.random()}"
    return " ".join(words)


def joined(df, *options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, *options).collect()}


def test_near_copies_with_and_without_their_original(spark, documents):
    rng = random.Random(4)
    rows, next_id = [], 100
    for family in range(4):
        base = [f"w{rng.randrange(4000)}" for _ in range(120 + family)]
        variants = [edited(base, rng.randrange(0, 5), rng) for _ in range(30)]
        for text in variants + ([" ".join(base)] * 3 if family % 2 else []):
            rows.append((next_id, text))
            next_id += rng.randrange(1, 4)
    rng.shuffle(rows)
    passage = " ".join(f"p{i}" for i in range(12))  # shared by documents that are otherwise unlike
    rows += [(d, " ".join(f"u{rng.random()}" for _ in range(40)) + " " + passage) for d in range(20)]
    for options in ((3, 9, 10), (5, 4, 5)):
        assert joined(documents(*rows), *options) == brute_force(rows, *options)


def test_edge_texts(spark, documents):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, long), (8, long + " x"), (9, "ONE TWO\vtwo")]
    assert joined(documents(*rows), 3, 9, 10) == brute_force(rows, 3, 9, 10)


def test_repeated_and_null_ids(spark, documents):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "q r s t"), (2, "a b c d"), (None, "a b c d"), (3, "q r s t"), (4, "z y x")]
    got = sorted(tuple(r) for r in jaccard_components(documents(*rows), 3, 9, 10).select("doc_id", "component_id").collect() if r[0])
    assert got == [(1, 1), (1, 1), (2, 1), (2, 1), (3, 1), (4, 4)]
    assert jaccard_components(documents(*rows).limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("(id * 37) % 201 as u", "((id + 1) * 37) % 201 as v")
    assert {r.component for r in components(edges).collect()} == {0}


def test_shingles_match_words_at_every_slice_size():
    texts = ["", None, "a", "A b", "ä B\x0bc  d", "x y z x y z x", " ", "é"]
    expected = [len(s) for s in sets_of(enumerate(texts), 3).values()]
    for limit in (1, 5, 1 << 20):
        got = [len(s) for part in text_slices(pa.array(texts), limit) for s in shingle_sets(part, 3)]
        assert got == expected
    assert Counter(expected)[0] == 3
