import os

import pytest

import cohortlift.llm  # noqa: F401  fails at once where the subpackage is missing

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, with columns that clash."""
    def make(*rows, score=1.0):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), score, 7, "x") for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, node string")

    return make


@pytest.fixture
def tokenizer_path():
    if not os.path.exists(TOKENIZER):
        pytest.skip("no tokenizer file")
    return TOKENIZER
