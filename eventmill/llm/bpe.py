"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

A sequence of tokens is what the merges give exactly if every two neighbours
are: so each prefix of a word has one last token, found from the prefixes before
it, and the encoding of the whole is the chain of last tokens read from its end.
A further character can only change what the end of the chain is: wherever the
word goes on, one of its tokens ends within the last ``lookahead`` places, the
symbols of the longest token that the merges make. Tokens that the chains of all
those places share are stable and go out; what is kept is the open end.

Words are encoded in this way once per task and remembered in a bounded table;
words beyond ``LONG`` symbols stream through and are not.
"""

from __future__ import annotations

import codecs
import functools
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from eventmill.llm.common import ids_and_texts

#: Entries of each table of a task before it starts anew; symbols up to which a word is remembered; texts per batch that goes out.
REMEMBERED, LONG, BATCH = 500_000, 64, 256


class Model:
    """A tokenizer file: its vocabulary, merges, word pattern and decoder."""

    def __init__(self, described: str):
        d = json.loads(described)
        model = d["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.texts = {i: t for t, i in (self.ids | self.special).items()}
        self.byte_decoder = d["decoder"] is not None
        normalizers = (d["normalizer"] or {}).get("normalizers", [])
        self.lower = any(n["type"] == "Lowercase" for n in normalizers)
        self.compose = any(n["type"] == "NFC" for n in normalizers)
        parts = d["pre_tokenizer"].get("pretokenizers", [])
        self.word = regex.compile(next((p["pattern"]["Regex"] for p in parts if p["type"] == "Split"), public_tokenizers.PATTERN))
        self.drops_space = self.compose
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the rest follow from 256
        rest = [b for b in range(256) if b not in set(plain)]
        self.letter = [""] * 256
        for b in plain:
            self.letter[b] = chr(b)
        for i, b in enumerate(rest):
            self.letter[b] = chr(256 + i)
        self.byte = {c: b for b, c in enumerate(self.letter)}
        self.parts: dict[str, tuple[int, str, str]] = {}  # token: rank of the merge that makes it, and its two sides
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.parts.setdefault(left + right, (rank, left, right))
        self.ranks = {(left, right): rank for rank, left, right in self.parts.values()}
        self.lookahead = max(map(self.length, self.parts), default=1)
        self.whole: dict[str, bool] = {}

    def length(self, token: str) -> int:
        """Symbols of a token: the mark of a word's end belongs to its last character."""
        return len(token) - (len(self.suffix) if self.suffix and token.endswith(self.suffix) else 0)

    def symbols(self, word: str) -> Iterator[str]:
        """The letters of a word, one at a time; the last one bears the mark of the end."""
        letter, raw = self.letter, word.encode()
        for b in raw[:-1]:
            yield letter[b]
        yield letter[raw[-1]] + self.suffix


@functools.lru_cache(maxsize=2)
def encoder(described: str) -> Encoder:
    """One for each Python worker, which keeps what it has encoded for its next task."""
    return Encoder(Model(described))


class Encoder:
    """Encodes words by one model."""

    def __init__(self, model: Model):
        self.model = model
        self.made = {token: i for token, i in model.ids.items() if self.reached(token)}
        #: What a token ends with, short of the whole token: where a look back for tokens can stop.
        self.ends = {token[i:] for token in self.made for i in range(1, len(token))}
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.edge = regex.compile("|".join(f"({regex.escape(s)})" for s in model.special)) if model.special else None

    def neighbours(self, left: str, right: str) -> bool:
        """Whether the merges, given both texts as one, give just these two tokens."""
        found = self.fits.get((left, right))
        if found is None:
            if len(self.fits) >= REMEMBERED:
                self.fits.clear()
            found = self.fits[left, right] = self.apart(left, right)
        return found

    def reached(self, token: str) -> bool:
        """Whether the merges make this token of its own text: no earlier merge pulls its two sides apart."""
        whole = self.model.whole
        found = whole.get(token)
        if found is None:
            made = self.model.parts.get(token)
            found = whole[token] = made is None or self.reached(made[1]) and self.reached(made[2]) and self.apart(made[1], made[2], made[0])
        return found

    def apart(self, left: str, right: str, limit: int = 1 << 60) -> bool:
        """Undo the later of both sides' last merges again and again: no merge across the border may have come before it."""
        ranks, parts = self.model.ranks, self.model.parts
        while True:
            across = ranks.get((left, right))
            if across is not None and across < limit:
                return False
            a, b = parts.get(left), parts.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[0] > b[0]:
                limit, left = a[0], a[2]
            elif a is None or b[0] > a[0]:
                limit, right = b[0] + 1, b[1]  # on a tie of one merge, the border's pair stands before it
            else:  # both made by one merge: the left one first
                limit, right = b[0] + 1, b[1]

    def stream(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of a word from its symbols, each as soon as it is stable."""
        made, ends, ahead, fits, neighbours = self.made, self.ends, self.model.lookahead, self.fits, self.neighbours
        held: list[str] = []  # symbols from the first open place on
        last: list[str | None] = []  # the last token of the prefix that ends at each of them
        before: str | None = None  # the token that went out last
        for symbol in symbols:
            held.append(symbol)
            text, start = symbol, len(held) - 1
            while True:
                if text in made:
                    left = last[start - 1] if start else before
                    if left is None and not start or left is not None and (fits.get((left, text)) or neighbours(left, text)):
                        last.append(text)
                        break
                start -= 1
                if start < 0 or text not in ends:
                    last.append(None)
                    break
                text = held[start] + text
            if len(held) >= 4 * ahead:
                out, used = self.stable(last, ahead)
                if out:
                    yield from out
                    before = out[-1]
                    del held[:used], last[:used]
        yield from self.chain(last, len(last))

    def chain(self, last: list, end: int) -> list[str]:
        """The tokens up to a place, by the chain of last tokens."""
        out = []
        while end > 0:
            token = last[end - 1]
            if token is None:  # a symbol that the vocabulary lacks has no id
                end -= 1
                continue
            out.append(token)
            end -= self.model.length(token)
        return out[::-1]

    def stable(self, last: list, ahead: int) -> tuple[list[str], int]:
        """Tokens that the chains of the last ``ahead`` places share, and their symbols."""
        n = len(last)
        ends = {end for end in range(n - ahead + 1, n + 1) if last[end - 1] is not None}
        while len(ends) > 1:
            far = max(ends)
            ends.remove(far)
            ends.add(far - self.model.length(last[far - 1]))
        used = ends.pop() if ends else 0
        return (self.chain(last, used), used) if used > 0 else ([], 0)

    def word(self, word: str) -> bytes:
        ids = self.model.ids
        found = self.words.get(word)
        if found is None:
            tokens = self.stream(self.model.symbols(word))
            if len(word) > LONG:  # its tokens go out while it is read; only ids gather
                return array("I", map(ids.__getitem__, tokens)).tobytes()
            found = array("I", map(ids.__getitem__, tokens)).tobytes()
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = found
        return found

    def lowered(self, text: str) -> str:
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()  # each character alone: no rule for a final sigma

    def plain(self, text: str) -> bytes:
        """The ids of a text without special tokens."""
        model = self.model
        if model.compose and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if model.lower:
            text = self.lowered(text)
        if not model.drops_space or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return b"".join(map(self.word, model.word.findall(text)))
        chunks, known = text.split(), self.chunks
        new = set(chunks).difference(known)
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = set(chunks)
        long: dict[str, bytes] = {}  # chunks of any length are kept for this text only
        for chunk in new:
            (known if len(chunk) <= LONG else long)[chunk] = b"".join(map(self.word, model.word.findall(chunk)))
        if long:
            return b"".join([long[c] if len(c) > LONG else known[c] for c in chunks])
        return b"".join([known[c] for c in chunks])

    def ids(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers; special tokens are found first."""
        if self.edge is None or not self.edge.search(text):
            return self.plain(text)
        out, at = [], 0
        for match in self.edge.finditer(text):
            out += [self.plain(text[at:match.start()]), self.model.special[match[0]].to_bytes(4, "little")]
            at = match.end()
        return b"".join([*out, self.plain(text[at:])])


class Decoder:
    """Text from ids, token by token: bytes are held back until they make a character."""

    def __init__(self, model: Model):
        self.model, self.texts = model, model.texts
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, token_id: int) -> str:
        text = self.texts[token_id]
        if text in self.model.special:
            out = self.state.decode(b"", True) + text
            self.state.reset()
            return out
        return self.state.decode(bytes(self.model.byte[c] for c in text))

    def decode(self, ids: list[int]) -> str:
        """As the file's decoder says: bytes to text, or without one the tokens, a space between them."""
        if not self.model.byte_decoder:
            return " ".join(map(self.texts.__getitem__, ids))
        self.state.reset()
        return "".join(map(self.push, ids)) + self.state.decode(b"", True)


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids binary, decoded string) of every row: ids as little-endian unsigned 32-bit integers.

    A missing text is an empty one: no ids, an empty text. Each row is on its
    own, so repeated rows and ids, missing ids and empty tables need no rule.
    """
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        described = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(described.value)
        decoder = Decoder(encode.model)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                ids = [encode.ids(t.as_py()) for t in batch.column("text")]
                texts = [decoder.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, ids binary, decoded string")
