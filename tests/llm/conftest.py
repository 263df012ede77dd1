import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def word_model():
    return str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="session")
def piece_model():
    return str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="session")
def byte_model():
    return str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): null and empty texts, null and repeated ids, repeated rows, one long text."""
    long = "lorem ipsum dolor " * 20_000
    return [
        (1, "one two  three"),
        (2, "one two\tthree"),
        (2, "one two\tthree"),
        (3, None),
        (4, ""),
        (5, " \n "),
        (6, long),
        (None, "no id here at all"),
        (7, "one two three"),
        (8, "été ñandú 日本 🎉 ١٢"),
    ]
