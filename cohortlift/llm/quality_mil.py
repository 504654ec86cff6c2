"""Quality classifier: attention-based multiple-instance learning over passages.

Every text is cut into passages of ``PASSAGE_WORDS`` words.  A passage is encoded from
what its bytes look like (frequencies of character-class pairs and of marks, word lengths, repeated words),
a gated attention layer weighs the passages of a document against each other, and the
weighted sum of their encodings gives the score.  All weights, attention included, are learnt from document
labels alone.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortlift.llm.words import Texts, mix, text_slices

PASSAGE_WORDS = 64
#: The fit uses about this many labelled documents at most, drawn by a hash of doc_id, with
#: all their passages.
MAX_FIT_DOCS = 6000
#: Labels that may be broadcast, by their counted number.
MOST_SENT = 1_000_000
#: Text that a task encodes at once and hands back.
_SLICE = 1 << 19
_HIDDEN, _GATE, _EPOCHS, _BATCH = 24, 12, 30, 64

_CLASSES = 8
_MARKS = [ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]


def _class_table() -> np.ndarray:
    """Lower, upper, digit, blank, line end, sentence mark, other mark, other byte."""
    table = np.full(256, 7, dtype=np.int64)
    for byte in range(128):
        c = chr(byte)
        table[byte] = (
            0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 4 if c in "\n\r"
            else 3 if c.isspace() else 5 if c in ".,;:!?'" else 6
        )
    return table


_CLASS = _class_table()
_MARK = np.full(256, len(_MARKS), dtype=np.int64)
_MARK[_MARKS] = np.arange(len(_MARKS))
N_FEATURES = _CLASSES * _CLASSES + len(_MARKS) + 8


def encode_passages(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the index of each row's first passage (one more than rows).

    A row without words is one passage.
    """
    starts, ends, first = texts.spans()
    n_words = np.diff(first)
    count = np.maximum(-(-n_words // PASSAGE_WORDS), 1)
    into = np.zeros(texts.rows + 1, dtype=np.int64)
    np.cumsum(count, out=into[1:])
    row = np.repeat(np.arange(texts.rows), count)
    rank = np.arange(into[-1]) - into[row]
    # Passages tile the bytes: each begins at its first word, a row's first one at the row.
    begin = texts.offsets[row]
    later = rank > 0
    begin[later] = starts[first[row[later]] + rank[later] * PASSAGE_WORDS]
    sizes = np.diff(np.append(begin, len(texts.data)))
    owner = np.repeat(np.arange(len(begin)), sizes)
    kinds = _CLASS[texts.data]
    following = np.append(kinds[1:], 4)
    last = (begin + sizes - 1)[sizes > 0]
    following[last] = 4
    n = len(begin)
    pairs = np.bincount(owner * 64 + kinds * 8 + following, minlength=n * 64).reshape(n, 64)
    marks = np.bincount(owner * 33 + _MARK[texts.data], minlength=n * 33).reshape(n, 33)[:, :32]
    scale = np.maximum(sizes, 1)[:, None]
    words = np.repeat(np.arange(n), np.minimum(np.maximum(n_words[row] - rank * PASSAGE_WORDS, 0), PASSAGE_WORDS))
    lengths = ends - starts
    in_passage = np.bincount(words, minlength=n)
    per_word = np.maximum(in_passage, 1)
    hashes = texts.word_hashes(starts, ends)
    distinct = np.unique(mix(hashes ^ mix(words.astype(np.uint64))), return_index=True)[1]
    shape = np.stack([
        in_passage / PASSAGE_WORDS,
        np.bincount(words, weights=lengths, minlength=n) / per_word / 16,
        np.bincount(words, weights=lengths <= 3, minlength=n) / per_word,
        np.bincount(words, weights=lengths >= 12, minlength=n) / per_word,
        np.bincount(words[distinct], minlength=n) / per_word,
        np.log1p(np.bincount(words, weights=lengths.astype(float) ** 2, minlength=n) / per_word) / 6,
        in_passage == 0,
        np.minimum(count[row], 8) / 8,
    ], axis=1)
    features = np.concatenate([np.log1p(100 * pairs / scale) / 4, np.log1p(100 * marks / scale) / 4, shape], axis=1)
    return features.astype(np.float32), into


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _forward(model: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Document logits with all inner values; ``first`` holds each bag's first passage, and the end."""
    code = np.tanh(x @ model["encode"] + model["encode_bias"])
    value, gate = np.tanh(code @ model["value"]), _sigmoid(code @ model["gate"])
    raw = (value * gate) @ model["weigh"]
    sizes = np.diff(first)
    top = np.repeat(np.maximum.reduceat(raw, first[:-1]), sizes)
    weight = np.exp(raw - top)
    weight = weight / np.repeat(np.add.reduceat(weight, first[:-1]), sizes)
    bag = np.add.reduceat(weight[:, None] * code, first[:-1])
    logit = bag @ model["score"] + model["score_bias"]
    return {"code": code, "value": value, "gate": gate, "weight": weight, "bag": bag, "logit": logit}


def _gradients(model, x, first, labels, share) -> dict[str, np.ndarray]:
    """Gradients of the weighted logistic loss, through the attention weights."""
    f, sizes = _forward(model, x, first), np.diff(first)
    d_logit = share * (_sigmoid(f["logit"]) - labels)
    d_bag = np.repeat(d_logit[:, None] * model["score"], sizes, axis=0)
    d_weight = (d_bag * f["code"]).sum(axis=1)
    mean = np.repeat(np.add.reduceat(f["weight"] * d_weight, first[:-1]), sizes)
    d_raw = f["weight"] * (d_weight - mean)
    d_gated = d_raw[:, None] * model["weigh"]
    d_value = d_gated * f["gate"] * (1 - f["value"] ** 2)
    d_gate = d_gated * f["value"] * f["gate"] * (1 - f["gate"])
    d_code = f["weight"][:, None] * d_bag + d_value @ model["value"].T + d_gate @ model["gate"].T
    d_code = d_code * (1 - f["code"] ** 2)
    return {
        "encode": x.T @ d_code, "encode_bias": d_code.sum(axis=0), "value": f["code"].T @ d_value,
        "gate": f["code"].T @ d_gate, "weigh": (f["value"] * f["gate"]).T @ d_raw,
        "score": f["bag"].T @ d_logit, "score_bias": d_logit.sum(keepdims=True),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights by Adam over shuffled batches of bags; the same bags in the same order give the same weights."""
    rng = np.random.default_rng(seed)
    mean = np.concatenate(bags).mean(axis=0)
    spread = np.concatenate(bags).std(axis=0) + 0.05
    bags = [(b - mean) / spread for b in bags]
    model = {
        "encode": rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, _HIDDEN)), "encode_bias": np.zeros(_HIDDEN),
        "value": rng.normal(0, 0.3, (_HIDDEN, _GATE)), "gate": rng.normal(0, 0.3, (_HIDDEN, _GATE)),
        "weigh": rng.normal(0, 0.3, _GATE), "score": rng.normal(0, 0.3, _HIDDEN), "score_bias": np.zeros(1),
    }
    first_moment = {k: np.zeros_like(v) for k, v in model.items()}
    second_moment = {k: np.zeros_like(v) for k, v in model.items()}
    epochs = max(_EPOCHS, min(8 * _EPOCHS, 30_000 // max(len(bags) // _BATCH, 1) // 10))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        rate = 0.004 * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(order), _BATCH):
            chosen = order[at : at + _BATCH]
            x = np.concatenate([bags[i] for i in chosen])
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
            share = np.full(len(chosen), 1 / len(chosen))
            step += 1
            for name, slope in _gradients(model, x, first, labels[chosen], share).items():
                slope = slope + 1e-4 * model[name]
                first_moment[name] = 0.9 * first_moment[name] + 0.1 * slope
                second_moment[name] = 0.99 * second_moment[name] + 0.01 * slope**2
                model[name] = model[name] - rate * (first_moment[name] / (1 - 0.9**step)) / (
                    np.sqrt(second_moment[name] / (1 - 0.99**step)) + 1e-8
                )
    return model | {"mean": mean, "spread": spread}


def predict(model: dict[str, np.ndarray], features: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _sigmoid(_forward(model, (features - model["mean"]) / model["spread"], first)["logit"])


def _packed(model: dict[str, np.ndarray]) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **model)
    return buffer.getvalue()


def _unpacked(model: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(model)) as held:
        return {name: held[name] for name in held.files}


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in text_slices(batch.column("text"), _SLICE):
            features, first = encode_passages(texts)
            rows = [features[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(texts.first, texts.rows) for c in ("doc_id", "label")] + [pa.array(rows, pa.binary())],
                names=["doc_id", "label", "bag"],
            )


def _fit_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).sort_by([("doc_id", "ascending"), ("bag", "ascending")])
    bags = [np.frombuffer(b, dtype=np.float32).reshape(-1, N_FEATURES).astype(float) for b in table.column("bag").to_pylist()]
    labels = table.column("label").to_numpy().astype(float)
    yield pa.RecordBatch.from_pydict({"model": [_packed(fit(bags, labels))]})


def train(labelled: DataFrame, max_docs: int = MAX_FIT_DOCS) -> bytes | None:
    """A model from rows of doc_id, text and label (0 or 1), or None without any usable row.

    About ``max_docs`` rows at most are used, chosen by a hash; passages are encoded in parallel and the
    bounded sample is fitted in one task.  Rows with a null doc_id or label are left out.
    """
    labelled = labelled.where("doc_id is not null and label in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("label").cast("int").alias("label"),
    )
    n = labelled.select("doc_id").count()
    share = min(1.0, max_docs / max(n, 1))
    drawn = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000))
    bags = drawn.mapInArrow(_bags, "doc_id long, label int, bag binary")
    found = bags.repartition(1).mapInArrow(_fit_one, "model binary").collect()
    return bytes(found[0].model) if found else None


def score(docs: DataFrame, model: bytes | None, out: str = "score") -> DataFrame:
    """``docs`` with ``out`` (0 to 1) added; 0.5 for all without a model.

    Null texts are scored as empty ones.  An input column of that name is replaced.
    """
    docs = docs.drop(out)
    if model is None:
        return docs.withColumn(out, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _unpacked(shared.value)
        for batch in batches:
            for texts in text_slices(batch.column("text"), _SLICE):
                scores = pa.array(predict(weights, *encode_passages(texts)), pa.float64())
                rows = batch.slice(texts.first, texts.rows)
                yield pa.RecordBatch.from_arrays([*rows.columns, scores], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def held_out(doc_id: Column, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the doc_id as text leaves ``remainder``; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor == remainder, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, divisor: int, remainder: int) -> DataFrame:
    """doc_id, text and label of the labelled documents outside the held-out part.

    A doc_id with conflicting labels has the greater one.  Up to ``MOST_SENT`` labels are sent to all executors (some 30 MB); more are joined by shuffle.
    """
    marked = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"), divisor, remainder)).groupBy(
        "doc_id").agg(F.max(label).alias("label"))
    if marked.count() <= MOST_SENT:
        marked = F.broadcast(marked)
    return docs.select("doc_id", "text").join(marked, "doc_id")
