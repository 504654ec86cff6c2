import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlift.llm import ball_tree, packing, source_mix, token_store, weighted_sampling

ODD = ["", None, "a.b", "a..b, c.", "it's. don't", "<|endoftext|> x", "İstanbul ΑΣ.", "3.5,a", "é á.b", "中文.a", "A.́x", "w " * 9000]


def encoded(path, text, end):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")


def test_token_store_round_trip(spark, documents, tokenizer_path, tmp_path):
    rows = [(100 - i, text) for i, text in enumerate(ODD)] + [(None, "n"), (50, "twice"), (50, "twice")]
    token_store.write_tokens(documents(*rows), f"{tmp_path}/s", tokenizer_path, 2)
    got = sorted((tuple(r) for r in token_store.token_index(spark, f"{tmp_path}/s").collect()), key=lambda r: r[1])
    start, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = encoded(tokenizer_path, text, 2)
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    assert {r.doc_id for r in token_store.read_tokens(spark, f"{tmp_path}/s", 98, 99).collect()} == {98, 99}
    token_store.write_tokens(documents(*rows).limit(0), f"{tmp_path}/e", tokenizer_path, 2)
    assert token_store.token_index(spark, f"{tmp_path}/e").count() == 0


@pytest.mark.parametrize("name,by_word", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_any_tokenizer_file_gives_its_own_ids(tokenizer_path, name, by_word):
    import os

    import pyarrow as pa

    from cohortlift.llm import token_ids

    path = os.path.join(os.path.dirname(tokenizer_path), name)
    assert token_ids.encoder(path).by_word is by_word
    got = []
    for _, ids, offsets in token_ids.encoded(pa.array(ODD), path, 7):
        got += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [encoded(path, text, 7).tolist() for text in ODD]


def test_packing_places_every_piece(spark, documents, tokenizer_path):
    docs = documents(*enumerate(ODD), (None, "x y"), (7, "a b c"), (7, "a b c"))
    frame = packing.pack(docs, capacity=64, tokenizer_path=tokenizer_path, end_id=1)
    placed = frame.toPandas()
    assert len(placed[placed.doc_id == 11]) == -(-9001 // 64)
    for _, part in placed.sort_values("offset").groupby("sequence_id"):
        assert (part.length.cumsum() - part.length).tolist() == part.offset.tolist() and part.length.sum() <= 64
    with_ids = packing.pieces(docs, tokenizer_path, capacity=64, with_ids=True)
    texts = packing.sequences(frame, with_ids).collect()
    assert sum(len(r.ids) for r in texts) == placed.length.sum()
    assert packing.pack(docs.limit(0), tokenizer_path=tokenizer_path, end_id=1).count() == 0


def test_packing_merges_over_levels(spark):
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 700, 4000)
    found = spark.createDataFrame(
        [(i, 0, 0, int(n), i) for i, n in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    placed = packing.pack_pieces(found, capacity=1000, node_rows=300).toPandas()
    assert len(placed) == 4000 and placed.groupby("sequence_id").length.sum().max() <= 1000
    assert placed.sequence_id.nunique() <= 1.01 * sizes.sum() / 1000 + 1
    alike = found.withColumn("length", F.lit(600).cast("long"))
    assert packing.pack_pieces(alike, capacity=1000, node_rows=300).select("sequence_id").distinct().count() == 4000


def test_targets_are_reshared_above_the_cap():
    assert source_mix.target_sizes([100, 100, 100], [5, 2, 1]).tolist() == pytest.approx([187.5, 75, 37.5])
    assert source_mix.target_sizes([10, 100, 100], [5, 2, 1]).tolist() == pytest.approx([30, 120, 60])
    assert source_mix.target_sizes([0, 10], [5, 2]).tolist() == [0, 10] and len(source_mix.target_sizes([], [])) == 0


def test_mix_meets_targets_and_reruns_agree(spark, documents):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 40)), f"s{i % 5}" if i % 7 else None) for i in range(1500)] + [(None, None, "s1"), (3, "w", "s3"), (3, "w", "s3")]
    docs = documents(*rows)
    options = {"block_words": 300, "shard_words": 2000}
    planned = source_mix.plan_mix(docs, **options).toPandas()
    planned["taken"] = planned._size * planned._shards.map(len)
    assert len(planned) == len(rows) and (planned.taken <= 3 * planned._size).all()
    for _, part in planned.groupby("source", dropna=False):
        assert part.taken.sum() == pytest.approx(part._target.iloc[0], rel=0.01)
    first, again = (sorted(map(tuple, source_mix.mix(d, **options).select("doc_id", "shard", "place").collect()), key=str)
                    for d in (docs, docs.repartition(7)))
    assert len(first) == planned._shards.map(len).sum() and Counter(r[1:] for r in first).most_common(1)[0][1] == 1
    assert {r[1] for r in first} == set(range(max(r[1] for r in first) + 1)) and first == again
    assert source_mix.plan_mix(docs.limit(0)).count() == 0
    clashing = docs.withColumns({"_source": F.col("source"), "_key": F.lit("k"), "place": F.lit("p"), "_row": F.lit(1)})
    kept = source_mix.mixed_rows(clashing, **options)
    assert kept.columns == clashing.columns and kept.count() == len(first)
    assert {(r.shard, r.place, r._key, r._row) for r in kept.collect()} == {(7, "p", "k", 1)}
    assert all(r._source == r.source for r in kept.select("source", "_source").collect())


def test_packing_ignores_clashing_columns(documents, tokenizer_path):
    docs = documents((1, "a b c"), (2, "d")).selectExpr("*", "99L as length", "'x' as piece", "0 as offset")
    placed = packing.pack(docs, tokenizer_path=tokenizer_path, end_id=1).collect()
    assert {(r.doc_id, r.piece) for r in placed} == {(1, 0), (2, 0)} and len({r.sequence_id for r in placed}) == 1


def brute_top(rows, asks, k):
    out = []
    for at, (q, vector) in enumerate(rows):
        if asks(q):
            scored = sorted((-int(np.dot(vector, v)), i) for n, (i, v) in enumerate(rows) if n != at and len(v) == len(vector))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "SHARD_VALUES", 1500)
    monkeypatch.setattr(ball_tree, "WAVE_VALUES", 240)
    rng = np.random.default_rng(6)
    vectors = {i: np.floor(8 * rng.normal(size=6)) for i in range(900)}
    vectors |= {i: np.full(6, 3.0) for i in range(900, 1300)}  # one vector many times
    vectors |= {2000 + i: np.floor(8 * rng.normal(size=3)) for i in range(5)}
    rows = [(i, v.tolist()) for i, v in vectors.items()]
    # Ids that come twice: with one vector, with another one, and as a query.
    rows += [(1, vectors[1].tolist()), (2, [40.0] * 6), (20, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), (40, vectors[40].tolist())]
    bad = [(3000, None), (3020, [1.0, None, 2.0]), (3040, [1.0, float("nan")]), (3060, []), (None, [1.0] * 6), (3080, [float("inf")] * 6)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, vector array<double>").repartition(3)
    got = sorted(tuple(r) for r in ball_tree.top_k(frame, F.col("vec_id") % 20 == 0, 7).collect())
    assert got == brute_top(rows, lambda i: i % 20 == 0, 7)
    assert ball_tree.top_k(frame.limit(0), F.col("vec_id") % 20 == 0, 7).count() == 0


def test_products_beyond_doubles_are_exact():
    left, right = np.array([[2.0**31, 3.0]]), np.array([[2.0**31 - 1, 1.0]])
    assert int(ball_tree._products(left, right)[0, 0]) == 2**31 * (2**31 - 1) + 3


@pytest.mark.parametrize("shard_rows", [1024, 9])
def test_fingerprints_estimate_generalised_jaccard(spark, documents, monkeypatch, shard_rows):
    monkeypatch.setattr(weighted_sampling, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"v{rng.integers(60)}" for _ in range(rng.integers(1, 200)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, rows[5][1]), (203, rows[5][1]), (204, "é" * 7), (204, "é" * 7), (None, "z z")]
    got = {}
    for r in weighted_sampling.edited_fingerprints(documents(*rows), slots=64).collect():
        got.setdefault(r.doc_id, []).append(r)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    errors = []
    for at, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b = Counter(text.split()), Counter(changed.split())
        rows_of = [r for r in got[doc_id] if r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()]
        assert rows_of and rows_of[0].n_chars == len(text)
        if a or b:
            errors.append(rows_of[0].near_edited - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08
    assert got[202][0].fingerprint == got[203][0].fingerprint and got[203][0].near_next == 1.0
    assert got[200][0].fingerprint == "" and len(got[204]) == 2
    assert weighted_sampling.edited_fingerprints(documents((1, "a")).limit(0)).count() == 0


def test_quantile_tables_follow_the_gamma_distribution():
    r, log_c = weighted_sampling._tables()
    assert np.mean(r) == pytest.approx(2, abs=2e-3) and np.var(r) == pytest.approx(2, abs=3e-2)
    for level in range(4):
        u = (np.arange(4096) + 0.5) / 4096 / 16.0**level
        c = np.exp(log_c[4096 * level : 4096 * (level + 1)])
        assert np.allclose(-np.expm1(-c) - c * np.exp(-c), u, rtol=1e-6)


def test_registered_fingerprints_tell_likenesses_apart(spark, documents):
    # Neighbours share one of their two blocks of words, and words of different pairs are different.
    rows = [(i, " ".join(f"b{k % 120}w{n}" for k in (i, i + 1) for n in range(60))) for i in range(120)]
    errors, own = [], dict(rows)
    for r in weighted_sampling.edited_fingerprints(documents(*rows)).collect():
        a, b = (Counter(own[d].split()) for d in (r.doc_id, (r.doc_id - 1) % 120))
        errors.append(r.near_next - sum((a & b).values()) / sum((a | b).values()))
        assert len(r.fingerprint) >= 8 * 64
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_token_files_have_the_promised_layout(documents, tokenizer_path, tmp_path):
    import glob

    import pyarrow.parquet as pq

    rows = [(i, "the cat sat on the mat. " * 40) for i in range(200)]
    token_store.write_tokens(documents(*rows), f"{tmp_path}/s", tokenizer_path, 2)
    files = glob.glob(f"{tmp_path}/s/**/*.parquet", recursive=True)
    seen = 0
    for name in files:
        group = pq.ParquetFile(name).metadata.row_group(0)
        columns = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
        for column in columns.values():
            assert column.has_offset_index and (column.has_column_index or column.path_in_schema.startswith("ids"))
        if "ids" in columns:
            assert any("DICTIONARY" in e for e in columns["ids"].encodings)
            assert "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings
            seen += group.num_rows
    assert seen == 200
