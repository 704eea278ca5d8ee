import json
import os
from pathlib import Path

import pytest

# Python workers import the package too, wherever pytest was started.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(Path(__file__).resolve().parents[2]), *filter(None, [os.environ.get("PYTHONPATH")])]
)


@pytest.fixture(scope="session")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(tokenizer_path):
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_str(json.dumps(json.loads(Path(tokenizer_path).read_text())))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text[, lang, source]) as a frame with the columns of documents and one more."""

    def make(rows):
        full = [(*r, *("en", "src0")[len(r) - 2 :], 0, "x") for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, digest string"
        )

    return make


ODD = [
    (1, "Same words in a row."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "Same words in a row."),
    (5, "Same words in a row."),
    (None, "Same words in a row."),
    (None, None),
    (6, "no-space-" * 40_000),
    (7, "many words that go on and on " * 9_000),
    (8, "é漢😀 <|endoftext|> <|im_end|> \x00 end"),
]
