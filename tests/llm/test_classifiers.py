import numpy as np
import pytest

from cohortlift.llm import quality_mil, toxicity

CLEAN = ["The river runs past the old mill and the town. ", "She read a book about ships, and then went home. ",
         "Bread is baked every morning in the small shop. "]
JUNK = ["$$$ ### buy!!! %%% now*** &&& ", "|| 12 || 99 || -- || 45 || ", "win@@@ $$$ 100% *** !!! "]
INSULTS = ("moron", "scumbag", "idiot")


def labelled(spark, make, n=240):
    return spark.createDataFrame([(i, make(i), i % 2) for i in range(n)], "doc_id long, text string, label int")


def test_quality_separates_held_out_texts(spark):
    def make(i):
        return "".join((CLEAN if i % 2 else JUNK)[(i // 2 + k) % 3] for k in range(3 + i % 40))

    model = quality_mil.train(labelled(spark, make))
    fresh = spark.createDataFrame([(1, CLEAN[0] * 9, 5.0), (2, JUNK[1] * 9, 5.0), (3, None, None), (4, "", 1.0)], "doc_id long, text string, score double")
    scores = {r.doc_id: r.score for r in quality_mil.score(fresh, model).collect()}
    assert scores[1] > 0.9 and scores[2] < 0.1 and scores[3] == scores[4] and 0 <= scores[3] <= 1


def test_gradients_of_the_attention_model():
    rng = np.random.default_rng(2)
    x, first = rng.normal(size=(9, quality_mil.N_FEATURES)), np.array([0, 2, 3, 9])
    labels, share = np.array([1.0, 0.0, 1.0]), np.full(3, 1 / 3)
    model = {"encode": rng.normal(size=(quality_mil.N_FEATURES, 4)) / 9, "encode_bias": rng.normal(size=4), "value": rng.normal(size=(4, 3)),
             "gate": rng.normal(size=(4, 3)), "weigh": rng.normal(size=3), "score": rng.normal(size=4), "score_bias": np.zeros(1)}

    def loss(m):
        z = quality_mil._forward(m, x, first)["logit"]
        return float(np.sum(share * (np.logaddexp(0, z) - labels * z)))

    slopes = quality_mil._gradients(model, x, first, labels, share)
    for name, slope in slopes.items():
        for at in list(np.ndindex(slope.shape))[:5]:
            up, down = ({k: v.copy() for k, v in model.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert slope[at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-7)


def test_untrained_and_empty(spark, documents):
    none = labelled(spark, lambda i: "x").limit(0)
    assert quality_mil.train(none) is None and toxicity.train(none) is None
    rows = documents((1, "a"), (None, None))
    assert {r.score for r in quality_mil.score(rows, None).collect()} == {0.5}
    assert {r.score for r in toxicity.score(rows, None).collect()} == {0.5}
    assert quality_mil.score(rows.limit(0), None).count() == 0


def test_toxic_words_decide_whatever_the_length(spark):
    rng = np.random.default_rng(5)

    def words(n):
        return ["".join(rng.choice(["ba", "re", "mo", "ti", "lan", "so"], rng.integers(1, 4))) for _ in range(n)]

    def make(i):
        text = words(int(rng.integers(30, 300)))
        for _ in range((i % 2) * 3):
            text.insert(int(rng.integers(len(text))), str(rng.choice(INSULTS)))
        return " ".join(text)

    model = toxicity.train(labelled(spark, make, 500))
    fresh = [(i, make(i)) for i in range(1000, 1100)] + [(1, None), (2, ""), (3, " ".join(words(20_000)))]
    rows = toxicity.score(spark.createDataFrame(fresh, "doc_id long, text string"), model).collect()
    right = [(r.score >= 0.5) == (r.doc_id % 2 == 1) for r in rows if r.doc_id >= 1000]
    assert np.mean(right) >= 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_hash_of_tables_is_sparks(spark):
    values = [0, 1, 255, 2**40 + 7, 2**55]
    got = [r.h for r in spark.createDataFrame([(v,) for v in values], "v long").selectExpr("xxhash64(v) as h").collect()]
    assert toxicity._xxhash64(np.array(values, dtype=np.uint64)).view(np.int64).tolist() == got


def test_probabilities_sum_to_one_whatever_the_number_of_ngrams(spark, monkeypatch):
    rng = np.random.default_rng(9)
    texts = [" ".join("".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(1500)) for _ in range(120)]
    model = toxicity.train(labelled(spark, lambda i: texts[i], len(texts)))
    grams = model.tables.where("part = 10")
    assert grams.count() > 300_000 and grams.select("gram").distinct().count() == grams.count()
    # Shares after a context and its left-over mass are all there is.
    shares = model.tables.where("part = 10").selectExpr("shiftright(gram, 8) as gram", "value")
    sums = shares.unionByName(model.tables.where("part = 11").select("gram", "value")).groupBy("gram").agg({"value": "sum"})
    low, high = sums.selectExpr("min(`sum(value)`)", "max(`sum(value)`)").first()
    assert low == pytest.approx(1, abs=1e-9) and high == pytest.approx(1, abs=1e-9)
    # Rows are whole and the same whether an n-gram travels by shuffle or to the tasks.
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[0]), (None, texts[1]), (2, None), (3, "aaaaaaaa ab aaaaaaaa")], "doc_id long, text string")
    got = sorted((tuple(r) for r in toxicity.score(docs, model).collect()), key=str)
    monkeypatch.setattr(toxicity, "COMMON_GRAMS", 30)
    assert len(got) == 5 and got == sorted((tuple(r) for r in toxicity.score(docs, model).collect()), key=str)


def test_plans_stay_small(spark):
    model = toxicity.train(labelled(spark, lambda i: "mild words " + INSULTS[i % 3] * (i % 2), 80))
    grams = spark.createDataFrame([(g, 1) for g in (0x0200000000006101, 0x0500000000616263)], "gram long, held long")
    gains = toxicity._gains(grams, model.tables)
    # The driver holds the plan of a query once for each of its stages.
    assert gains._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 4
    assert model.tables._jdf.queryExecution().optimizedPlan().toString().count("Aggregate ") == 0
    assert gains.count() == 2 and gains.where("gain is null").count() == 0
