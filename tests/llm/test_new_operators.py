import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlift.llm import importance, positional_index, walsh_codes
from cohortlift.llm.words import text_slices

import pyarrow as pa

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = ["", None, "a", "A b", "don't  stop\nnow", "É x3É ÀB", "中文 a中", "x" * 40 + " " + "y" * 300, "[]{}`@", "a b " * 4000]


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, width):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, width + 1) for i in range(len(w) - n + 1)]


def test_crcs_compose():
    rng = np.random.default_rng(3)
    parts = [rng.bytes(int(n)) for n in (0, 1, 2, 7, 300, 70000)]
    for a in parts:
        left = np.full(len(parts), zlib.crc32(a), dtype=np.uint32)
        right = np.array([zlib.crc32(b) for b in parts], dtype=np.uint32)
        got = importance.composed(left, right, np.array([len(b) for b in parts]))
        assert got.tolist() == [zlib.crc32(a + b) for b in parts]


@pytest.mark.parametrize("most", [0, 3, 1 << 16])
def test_dictionary_emits_the_payload_of_every_word(most):
    held = importance.WordDictionary(most)
    for _ in range(3):  # words are outside the dictionary first and inside later
        for texts in text_slices(pa.array(ODD), 64):
            crcs, lengths, first = held.scan(texts)
            for row in range(texts.rows):
                want = [w.encode() for w in words(ODD[texts.first + row])]
                part = slice(first[row], first[row + 1])
                assert crcs[part].tolist() == [zlib.crc32(w) for w in want]
                assert lengths[part].tolist() == [len(w) for w in want]
    assert len(held.automaton) <= most


def plain_resample(docs, target, width, buckets, percent, least):
    def counts(texts):
        out = [0] * buckets
        for text in texts:
            for g in grams(text, width):
                out[zlib.crc32(g.encode()) % buckets] += 1
        return out

    s, t = counts(text for _, text in docs), counts(target)
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        g = [gain[zlib.crc32(x.encode()) % buckets] for x in grams(text, width)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(g), weight, score, len(words(text))])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, -r[1], -r[2]))
    ranks = {id(r): n for n, r in enumerate(able[: percent * len(able) // 100], 1)}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


@pytest.mark.parametrize("width", [1, 3])
def test_resampling_equals_brute_force(spark, documents, width, many_shards):
    rng = np.random.default_rng(5)
    vocabulary = ["w%d" % i for i in range(80)] + ["É", "中文", "don't"]
    docs = list(enumerate(ODD)) + [
        (i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 60))))) for i in range(10, 200)] + [(None, "n " * 30), (50, "w1 " * 25)]
    target = [" ".join(vocabulary[:20]), None, "w1 w2 w3"]
    frame = documents(*docs)
    aims = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(target)], "item_id long, text string, score double")
    got = importance.resample(frame, aims, width, 97, 30, 5)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    key = str
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain_resample(docs, target, width, 97, 30, 5), key=key)
    kept = importance.drawn(frame, got.where("doc_id <> 50"))
    assert kept.columns == frame.columns and kept.count() == got.where("rank is not null and doc_id <> 50").count()


def test_resampling_of_empty_tables(spark, documents):
    docs = documents(*[(i, "a b c " * 10) for i in range(20)])
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(docs.limit(0), none).count() == 0
    rows = importance.resample(docs, none).collect()
    assert sorted(r.rank for r in rows if r.rank) == [1, 2] and len({r.weight for r in rows}) == 1


def plain_hits(docs, items, width):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            iw = words(item_text)
            for b in range(max(len(iw) - width, 0) + 1 if iw else 0):
                run = iw[b : b + width]
                for p in range(len(w) - len(run) + 1):
                    if w[p : p + len(run)] == run:
                        hit.update(range(p, p + len(run)))
                        found.add("" if item is None else str(item))
        out.append((doc_id, len(w), tuple(sorted(hit)), tuple(sorted(found))))
    return out


def read_hits(frame):
    return [(r.doc_id, r.n_words, tuple(p for s in r.spans for p in range(s.begin, s.end)), tuple(r.items)) for r in frame.collect()]


def leaked():
    rng = np.random.default_rng(9)
    vocabulary = ["t%d" % i for i in range(12)] + ["É", "the"]
    items = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 15))))) for i in range(12)] + [
        (3, "the the the the the"), (None, "t1 t2 t3 É"), (90, ""), (91, None), (10, "The, THE the; the. the t1")]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 40)))) for _ in range(60)]
    texts += [f"x {t or ''} y {t or ''}" for _, t in items] + ["the " * 3000, "t1", "t2 t3 É t4"]
    return list(enumerate(ODD + texts)) + [(None, "t1 t2 t3 é É t1 t2 T3 É"), (7, "the the the the the"), (7, "the the the the the")], items


@pytest.mark.parametrize("settings", [{}, {"BLOCK_BYTES": 200, "ITEM_WORDS": 20, "CANDIDATES": 7, "ITEM_PART": 8}])
def test_contamination_equals_brute_force(spark, documents, tmp_path, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(positional_index, name, value)
    docs, items = leaked()
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    got = positional_index.contamination(documents(*docs).withColumn("block", F.lit(1)), frame, f"{tmp_path}/i", width=5)
    assert sorted(read_hits(got), key=str) == sorted(plain_hits(docs, items, 5), key=str)


def test_spans_are_merged_and_empty_tables_have_results(spark, documents, tmp_path):
    docs = documents((1, "z a b c a b c z"), (2, None))
    items = spark.createDataFrame([("q", "a b c"), ("r", "b c a")], "item_id string, text string")
    rows = {r.doc_id: r for r in positional_index.contamination(docs, items, f"{tmp_path}/a", width=3).collect()}
    assert [tuple(s) for s in rows[1].spans] == [(1, 7)] and rows[1]["items"] == ["q", "r"] and rows[2].spans == []
    assert read_hits(positional_index.contamination(docs, items.limit(0), f"{tmp_path}/b"))[0][2:] == ((), ())
    assert positional_index.contamination(docs.limit(0), items, f"{tmp_path}/c").count() == 0


def test_proximity_matches_allow_words_between(spark, documents, tmp_path):
    docs = documents((1, "alpha beta gamma"), (2, "alpha x beta gamma"), (3, "beta alpha gamma"), (4, "alpha x x x beta gamma"), (5, "alpha beta"))
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id int, text string")
    near = {slop: sorted(r.doc_id for r in positional_index.contamination(docs, items, f"{tmp_path}/{slop}", slop=slop).collect() if r["items"])
            for slop in (0, 1)}
    assert near == {0: [1], 1: [1, 2, 3]}


def plain_codes(vectors, parts, entries, rounds):
    width = len(vectors[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in vectors]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        out = []
        for row in cut:
            line = []
            for p in range(parts):
                d = [sum((a - b) ** 2 for a, b in zip(row[p], e)) for e in books[p]]
                line.append((d.index(min(d)), min(d)))
            out.append(line)
        return out

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut[i][p] for i in range(len(cut)) if got[i][p][0] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    got = assign()
    flat = ",".join(str(c) for book in books for e in book for c in e)
    return [("".join(f"{i:02x}" for i, _ in line), sum(d for _, d in line)) for line in got], hashlib.sha256(flat.encode()).hexdigest()


def test_transform_keeps_distances_and_elimination_is_exact():
    rng = np.random.default_rng(2)
    h = walsh_codes.sequency_matrix(8)
    assert (h @ h.T == 8 * np.eye(8)).all() and ((np.diff(h, axis=1) != 0).sum(axis=1) == np.arange(8)).all()
    for width, kind in ((1, np.int64), (3, np.int64), (8, np.int64), (8, object)):
        parts, entries = rng.integers(-9, 9, (500, width)).astype(kind), rng.integers(-9, 9, (16, width)).astype(kind)
        if kind is object:
            parts, entries = parts * (1 << 50), entries * (1 << 50)
        full = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        index, least = walsh_codes.nearest(parts, entries)
        assert (index == full.argmin(axis=1)).all() and (least == full.min(axis=1)).all()
    assert len(walsh_codes.nearest(np.zeros((0, 4), dtype=np.int64), np.zeros((2, 4), dtype=np.int64))[0]) == 0


@pytest.mark.parametrize("size", [1.0, 1e6])
def test_codes_equal_brute_force(spark, size):
    rng = np.random.default_rng(4)
    vectors = [[float(np.float32(x * size)) for x in rng.normal(size=6)] for _ in range(60)]
    vectors += [vectors[3]] * 3 + [[0.0] * 6]
    rows = [(i, v, i % 3 if i % 3 else None, "x", 1) for i, v in enumerate(vectors)]
    bad = [(-5, None, 1, "x", 1), (-4, [1.0, None] + [0.0] * 4, 1, "x", 1), (-3, [float("nan")] * 6, 1, "x", 1),
           (-2, [float("inf")] * 6, 1, "x", 1), (-1, [], 1, "x", 1), (900, [1.0], 1, "x", 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int, code string, error int")
    codes = walsh_codes.train(frame, parts=3, entries=5, rounds=3)
    got = {r.vec_id: r for r in walsh_codes.label_errors(codes.encode()).collect()}
    want, digest = plain_codes([[math.floor(x * 4096) for x in v] for v in vectors], 3, 5, 3)
    most = (1 << 63) - 1
    assert {i: (r.code, r.error) for i, r in got.items()} == {i: (c, min(e, most)) for i, (c, e) in enumerate(want)}
    assert codes.digest() == digest
    for label in (None, 1, 2):
        total = sum(min(want[i][1], most) for i, *_ in rows if rows[i][2] == label)
        assert {r.label_error for r in got.values() if r.label == label} == {min(total, most)}


def test_codes_of_few_repeated_and_no_rows(spark):
    kind = "vec_id long, embedding array<double>, label string"
    frame = spark.createDataFrame([(1, [2.0, 1.0, 0.5], "a"), (1, [2.0, 1.0, 0.5], "a"), (None, [1.0, 1.0, 0.0], None)], kind)
    rows = walsh_codes.label_errors(walsh_codes.train(frame, parts=2, entries=16).encode()).collect()
    assert len(rows) == 3 and all(r.error == 0 for r in rows)
    empty = walsh_codes.train(frame.limit(0))
    assert empty.encode().count() == 0 and empty.digest() == hashlib.sha256(b"").hexdigest()


def test_jobs_of_a_round_do_not_grow_with_partitions(spark, many_shards):
    frame = spark.range(40).selectExpr("id AS vec_id", "array(id, 7 * id % 11, 3L, id % 5) AS vector")
    books = np.split(np.array([[0, 0, 3, 0], [20, 5, 3, 1], [39, 9, 3, 4]]), 2, axis=1)
    key, context = "spark.sql.shuffle.partitions", spark.sparkContext
    own = spark.conf.get(key)
    jobs, found = [], []
    try:
        for n in (3, 60):
            spark.conf.set(key, str(n))
            context.setJobGroup(f"codes-{n}", "a round of codebooks")
            found.append(np.concatenate(walsh_codes.refined(frame, books)).tolist())
            jobs.append(len(context.statusTracker().getJobIdsForGroup(f"codes-{n}")))
    finally:
        spark.conf.set(key, own)
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert found[0] == found[1] and 0 < jobs[0] == jobs[1]
