"""Subword encoding and decoding against the sentencepiece library."""

import random

import helpers
import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from eventmill.llm import subwords
from eventmill.llm.common import Remembered

ALPHABET = "aabcdeéèß ΣσİıǅǺ́  \t\n\x0b\x1c\x85  　中文字😀's't!!..,--123٣४▁\x00"


@pytest.fixture(scope="module")
def both():
    model = subwords.model_file()
    return subwords.Encoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)


def texts():
    rng = random.Random(2)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    out += ["a" * n for n in (1, 2, 63, 64, 65, 300, 5001)] + ["".join(rng.choice("aab ") for _ in range(3000)), "<s>", "</s> <unk> <0x41>", " " * 100, "  a   b", "中文字" * 500]
    return [*out, *(t for _, t in helpers.AWKWARD if t)]


def test_same_as_the_library(both):
    encode, library = both
    for text in texts():
        ids = library.encode(text)
        assert np.frombuffer(encode.ids(text), "<i4").tolist() == ids
        assert subwords.decoded(encode.pieces, ids) == subwords.Decoder(encode.pieces).decode(ids) == library.decode(ids)


def test_decodes_any_ids(both):
    encode, library = both
    rng = random.Random(3)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, *range(3, 20), *range(100, 259), rng.randrange(32000)]) for _ in range(rng.randint(0, 8))]
        assert subwords.decoded(encode.pieces, ids) == subwords.Decoder(encode.pieces).decode(ids) == library.decode(ids)


def test_agenda_is_what_merging_the_best_pair_gives(both):
    """The plain way: look at all neighbours, merge the leftmost best, start again."""
    encode, _ = both
    rank, rng = encode.pieces.rank, random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("theanrio▁sg") for _ in range(rng.randint(1, 40)))
        symbols = list(text)
        while pairs := [(rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in rank]:
            i = min(pairs)[1]
            symbols[i:i + 2] = ["".join(symbols[i:i + 2])]
        assert encode.agenda_list(text) == encode.agenda_heap(text) == symbols


def test_parts_change_nothing(both):
    encode, library = both
    for text in texts()[:300] + ["中文字" * 30 + "hello there" * 20]:
        if text:
            assert encode.encoded("▁" + text.replace(" ", "▁")) == encode.ids(text)
    encode.check(library)
    assert not encode.new
    encode.new = [("▁the", b"\0\0\0\0")]
    with pytest.raises(ValueError, match="the"):
        encode.check(library)
    encode.new = []
    assert max(map(len, encode.parts)) <= encode.parts.longest and len(encode.parts) <= encode.parts.most


def test_what_is_common_stays(monkeypatch):
    table = Remembered()
    monkeypatch.setattr(Remembered, "most", 10)
    for i in range(1000):
        for word in ("a", "b", f"rare{i}"):
            assert table.get(word) or table.recall(word) or table.keep(word, word) == word
        assert len(table) <= 10 and len(table.older) <= 10
    assert {"a", "b"} <= set(table) | set(table.older)
    table.keep("x" * 65, 1)
    assert "x" * 65 not in table


def test_batches_change_nothing(both, monkeypatch):
    """Texts that are encoded together, more new parts than are remembered, groups of few characters."""
    _, library = both
    every = texts() + ["Wörter, die\nneu sind: " + "".join(random.Random(i).choices("aeinstr", k=9)) + "!" for i in range(300)]
    want = [np.array(library.encode(t), "<i4").tobytes() for t in every]
    monkeypatch.setattr(Remembered, "most", 50)
    monkeypatch.setattr(subwords, "SIDE", 7)
    for characters in (1, 500, subwords.CHARACTERS):
        monkeypatch.setattr(subwords, "CHARACTERS", characters)
        encode = subwords.Encoder(subwords.model_file())
        assert encode.ids_of_all(every) == want
        encode.check(library)
        assert encode.ids_of_all([]) == [] and len(encode.parts) <= 50


def test_a_known_word_is_not_new_next_to_other_characters():
    encode = subwords.Encoder(subwords.model_file())
    encode.ids("the small bird\n1")
    encode.ids(", . ! small")
    encode.new = []
    encode.ids("the, the. small! the1 bird. the,")
    assert {part for part, _ in encode.new} <= {",", ".", "!", "1"}


def test_parts_are_put_to_the_library_many_in_a_text():
    encode, library = subwords.Encoder(subwords.model_file()), subwords.library(subwords.model_file())

    class Counted:
        texts = 0

        def encode(self, wanted, **how):
            self.texts += len(wanted)
            return library.encode(wanted, **how)

    rng, counted = random.Random(7), Counted()
    encode.ids(" ".join("".join(rng.choices("abcdefghijk", k=9)) for _ in range(1000)))
    new = list(encode.new)
    encode.check(counted)
    assert len(new) > 900 and counted.texts <= len(new) // 10
    for k in (0, 63, 64, len(new) - 1):  # a wrong one is found wherever it stands
        encode.new = [*new[:k], (new[k][0], new[k][1] + b"\1\0\0\0"), *new[k + 1:]]
        with pytest.raises(ValueError, match=repr(new[k][0])):
            encode.check(library)


def test_other_models_are_refused():
    described = sentencepiece_model_pb2.ModelProto.FromString(subwords.model_file())
    described.trainer_spec.model_type = described.trainer_spec.UNIGRAM
    with pytest.raises(ValueError, match="merge-type"):
        subwords.Pieces(described.SerializeToString())


def test_table(spark, both):
    _, library = both
    got = subwords.encode_and_decode(helpers.documents(spark)).collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in helpers.AWKWARD]
    assert helpers.by_id((r.doc_id, list(r.ids), r.decoded) for r in got) == helpers.by_id(want)
    assert subwords.encode_and_decode(helpers.documents(spark, [])).collect() == []
