"""Encoding and decoding against the tokenizers library."""

import random
import tracemalloc

import helpers
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventmill.llm import bpe

ALPHABET = "aabcdeéèß ΣσİıǅǺ́  \t\n\x0b\x1c\x85  　中文字😀's't!!..,--123٣४"


def texts():
    rng = random.Random(2)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    out += ["a" * n for n in (1, 2, 63, 64, 65, 257, 5001)] + ["".join(rng.choice("aab") for _ in range(3000)), "=-" * 2000, "é" * 2000]
    return out + ["hello <|startoftext|>world<|endoftext|><|endoftext|>", "<|endoftext|", "", " ", "don't I'LL'RE", *(t for _, t in helpers.AWKWARD if t and len(t) < 5000)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_same_as_the_library(name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        encode = bpe.encoder(file.read())
    decoder = bpe.Decoder(encode.model)
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode.ids(text), "<u4").tolist() == ids
        assert decoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_open_end_stays_small():
    """Tokens go out while the word is read: what is held does not grow with it."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encode = bpe.encoder(file.read())
    rng, read = random.Random(5), 0

    def symbols():
        nonlocal read
        for _ in range(20_000):
            read += 1
            yield rng.choice("etaoinshr")

    done, most = 0, 0
    for token in encode.stream(symbols()):
        done += len(token)
        most = max(most, read - done)
    assert done == 20_000 and most <= 12 * encode.model.lookahead


def test_long_words_are_not_kept():
    """A word of a megabyte: while it is encoded little more than the word and its ids is held, and none of it stays."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encode = bpe.Encoder(bpe.Model(file.read()))
    rng = random.Random(7)
    word = "".join(rng.choices("etaoinshr", k=5_000)) * 200
    encode.ids(word[:20_000])  # fills the table of neighbours, which is bounded by itself
    tracemalloc.start()
    ids = encode.ids(f"a {word} b")
    stays, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(ids) > 400_000 and most < 4 * len(word) + 8 * len(ids)
    assert stays < 2 * len(ids) + 2_000_000 and not [c for c in encode.chunks if len(c) > bpe.LONG] and word not in encode.words


def test_table(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = bpe.encode_and_decode(helpers.documents(spark)).collect()
    want = []
    for i, text in helpers.AWKWARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert helpers.by_id((r.doc_id, bytes(r.ids), r.decoded) for r in got) == helpers.by_id(want)
    assert bpe.encode_and_decode(helpers.documents(spark, [])).collect() == []
