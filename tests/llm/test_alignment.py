"""Token alignment against byte ranges of all tokens, compared one by one."""

import bisect
import hashlib
import random
from collections import Counter

import helpers
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from eventmill.llm import alignment, subwords

ALPHABET = "aabcdeéèß ΣσİıǅǺ́  \t\n\x0b\x1c\x85  　中文字😀🧬𐍈's't!!..,--123٣४\x00"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    with open(A_PATH, encoding="utf-8") as file:
        return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH), alignment.Aligner(file.read(), subwords.model_file())


def ranges(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(models, text):
    """Groups as text and links, from the byte range of each token."""
    a, b, aligner = models
    whole = (" " + (text or "")).encode()
    of_a = [(i, aligner.a_bytes[i]) for i in a.encode(" " + (text or ""), add_special_tokens=False).ids]
    of_b = []
    for i in b.encode(text or ""):
        piece = b.id_to_piece(i)
        of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if not text or any(b"".join(raw for _, raw in side) != whole for side in (of_a, of_b)):
        return 0, 0, "", []
    of_a, of_b = ranges(of_a), ranges(of_b)
    links = [(x, y) for x, _, e in of_a for y, _, f in of_b if e == f] if len(text) < 3000 else None
    cuts = sorted({e for _, _, e in of_a} & {e for _, _, e in of_b})
    groups = [([], []) for _ in cuts]
    for side in (0, 1):
        for i, _, e in (of_a, of_b)[side]:
            groups[bisect.bisect_left(cuts, e)][side].append(str(i))
    return len(of_a), len(of_b), ";".join("|".join(map(",".join, g)) for g in groups), links


def texts():
    rng = random.Random(4)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    out += ["", " ", "a", "▁", "a ▁ b", "<|endoftext|> x <s>", "naïve 🧬🧬 𐍈𐍈 x", "\U0010fffd\U000e0001 a", "中文" * 40, "a  b   c\n\n d"]
    return [*out, *(t for _, t in helpers.AWKWARD if t and len(t) < 3000)]


def test_groups_and_links(models):
    inner = 0
    for text in texts():
        n_a, n_b, groups, links = plain(models, text)
        got = models[2].texts([text])[0] or (0, 0, "", [])
        assert got[:3] == (n_a, n_b, groups), text
        assert Counter((int(x) >> 32, int(x) & 0xFFFFFFFF) for x in got[3]) == Counter(links), text
        inner += n_a > 0 and len(groups.split(";")) > len(set(" " + text)) and "𐍈" in text
    assert inner


def test_together_as_alone(models):
    """Parts that are aligned in one go, those of texts without tokens among them."""
    a, b, aligner = models
    with open(A_PATH, encoding="utf-8") as file:
        fresh = alignment.Aligner(file.read(), subwords.model_file())
    many = texts()
    for text, got in zip(many, fresh.texts(many)):
        assert (got or (0, 0, "", []))[:3] == plain(models, text)[:3]


def test_cuts_within_characters(models):
    """Bytes where tokens of both end are cuts, also inside a character."""
    groups = models[2].texts(["\U000e0041"])[0][2]
    assert groups == plain(models, "\U000e0041")[2] and groups.count(";") >= 2


def test_the_vocabularies_bound_the_pairs(models):
    assert alignment.most_pairs([b"ab", b"b"], [b"b", b"cab", b"b"]) == 2 + 2 + 2
    assert alignment.most_pairs(models[2].a_bytes, models[2].b_bytes) <= alignment.MOST_BROADCAST


def want(models, rows):
    found = [(i, *plain(models, t)) for i, t in rows]
    total = Counter(link for *_, links in found for link in links)
    highest = {}
    for (_, b), n in total.items():
        highest[b] = max(n, highest.get(b, 0))
    return [(i, n_a, n_b, len(links), len(links), sum(total[x] == highest[x[1]] for x in links), sum(total[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for i, n_a, n_b, g, links in found]


@pytest.mark.parametrize("most", [alignment.MOST_BROADCAST, 0])
def test_table(spark, models, monkeypatch, most):
    monkeypatch.setattr(alignment, "MOST_BROADCAST", most)
    rows = [(i, t if t is None or len(t) < 3000 else t[:2500]) for i, t in helpers.AWKWARD] + [(100 + i, t) for i, t in enumerate(texts()[:200])]
    got = alignment.summed_up(alignment.align(helpers.documents(spark, rows))).collect()
    assert got[0].__fields__ == ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert helpers.by_id([r[c] for c in names] for r in got) == helpers.by_id(want(models, rows))
    assert alignment.summed_up(alignment.align(helpers.documents(spark, []))).collect() == []


def test_long_text(models):
    """A long part is aligned whole, and not remembered."""
    aligner = models[2]
    text = "x" * 30_000 + " " + "word " * 30_000
    got, = aligner.texts([text])
    assert got[:3] == plain(models, text)[:3] and " " + "x" * 30_000 not in aligner.known


def test_parts_side_by_side(models):
    """New parts of a batch are encoded as few strings, and have the tokens that they have alone."""
    aligner = models[2]
    words = [f" w{i}é" for i in range(300)]
    odd = [" ", "  two", " end ", " ▁", " ▁x▁", " a\nb", "​", " \x00", " <|endoftext|>", " \U000e0041"]
    parts = [part for i, part in enumerate(words) for part in ([part, odd[i % len(odd)]] if i % 29 == 0 else [part])]
    assert len(aligner.strings(words)) == 6
    assert "".join(aligner.strings(parts)) == "".join(parts) and all(len(part) > 1 for part in aligner.strings(parts) if part not in odd)
    plain = lambda found: [f and (f[0], f[1], f[2], bytes(f[3])) for f in found]
    assert plain(aligner.aligned(parts)) == [plain(aligner.aligned([part]))[0] for part in parts]


@pytest.mark.parametrize("text", ["a b", "a  b", " a", "a ", "a\nb c", "a \nb", "a\n b", " ", "\n", "a b\n", "  a", "a b c"])
def test_parts_as_by_the_pattern(models, text):
    assert models[2].parts(" " + text) == models[2].cut_at.split(" " + text)
