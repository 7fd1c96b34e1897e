"""Very long words: the same ids as the library, in a time that grows with their length."""

import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quietude.llm.bpe import Vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as f:
        return Vocabulary(f.read()), Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", [
    "a" * 100_000, "ab" * 5000, "".join(random.Random(1).choices("etaoinshrdlu", k=32_000)), "\u00e9\u4e2d" * 700, "=" * 4097,
    " ".join("x" * n for n in range(30, 140)),
], ids=["one-letter", "two-letters", "random", "not-ascii", "signs", "many-lengths"])
def test_long_words_as_the_library(both, text):
    vocab, library = both
    start = time.time()
    ids, counts = vocab.encode([text])
    assert time.time() - start < 20
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert counts.tolist() == [len(ids)]
    assert vocab.decode(ids, counts) == [text]


def test_a_full_cache_is_emptied_and_gives_the_same_ids(both, monkeypatch):
    vocab, library = both
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(400)) for _ in range(20)]
    monkeypatch.setattr("quietude.llm.bpe.CACHE_BYTES", 100_000)
    vocab.forget()
    for text in [*texts, "z" * 200_000, texts[0]]:  # one word longer than the cache
        assert vocab.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert vocab.cache_bytes <= 100_000
