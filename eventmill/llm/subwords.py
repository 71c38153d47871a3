"""SentencePiece encoding and decoding of merge-type vocabularies.

A text becomes one string in which each blank is U+2581, one more of them in
front. Its characters are symbols; an agenda holds every two neighbours whose
joined text is a piece, best score first and leftmost on a tie. The best pair
becomes one symbol, its new neighbours enter the agenda, entries whose symbols
are gone are skipped, until none is left. A symbol that is no piece becomes one
piece for each of its bytes.

No piece has U+2581 behind another character, so no merge crosses a place where
a blank follows something else, nor two characters that no piece holds side by
side: texts are cut there, and what was cut is encoded once per worker and
remembered if it is short. The parts that are new in a batch have their agendas
side by side in arrays, a merge of each at a time; a long part has a heap.
Decoding goes piece by piece and holds bytes back until they make a character.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import itertools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from eventmill.llm.common import Remembered, ids_and_texts

SPACE = "▁"
#: Texts per batch that goes out, and characters of texts that are cut at a time.
BATCH, CHARACTERS = 256, 1_000_000
#: Parts whose agendas are worked off side by side, and parts per text that is put to the library.
SIDE, JOINED = 4096, 64
#: How a model file numbers the types of pieces.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Code points; the bits of a place in a short part; behind every score: two symbols whose joined text is no piece.
POINTS, PLACE, NEVER = 0x110000, (Remembered.longest + 1).bit_length(), np.iinfo(np.int64).max

codecs.register_error("each_byte", lambda error: ("�", error.start + 1))


class Pieces:
    """A model file: its pieces, their scores and bytes."""

    def __init__(self, model: bytes):
        described = sentencepiece_model_pb2.ModelProto.FromString(model)
        types = {p.type for p in described.pieces}
        if described.trainer_spec.model_type != described.trainer_spec.BPE or types - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("not a merge-type vocabulary of plain pieces, or one with pieces of the user's own")
        if described.normalizer_spec.precompiled_charsmap or not described.normalizer_spec.add_dummy_prefix or described.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("texts of this model are normalised before they are cut")
        pieces = list(enumerate(described.pieces))
        self.ids = {p.piece: i for i, p in pieces if p.type == NORMAL}
        self.rank = {p.piece: -p.score for _, p in pieces if p.type == NORMAL}
        self.texts = [p.piece for _, p in pieces]
        self.types = [p.type for _, p in pieces]
        self.byte_ids = [i for _, i in sorted((int(p.piece[3:5], 16), i) for i, p in pieces if p.type == BYTE)]
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces to fall back on")
        #: What a token stands for in the text; nothing for those that stand for no text.
        self.bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else b"" for _, p in pieces]
        self.side_by_side = {t[i:i + 2] for t in self.ids for i in range(len(t) - 1)}
        self.cuts_at_blanks = not any(SPACE in t.lstrip(SPACE) for t in self.ids)
        self.apart = next(c for c in map(chr, range(1, POINTS)) if not any(c in t for t in self.ids))  # joined with nothing

    def together(self) -> list[set[str]]:
        """Sets of characters: no piece holds characters of two sets."""
        pairs = [pair for pair in self.side_by_side if pair[0] != SPACE]
        sets = {character: {character} for pair in pairs for character in pair}
        for first, second in pairs:
            if (found := sets[first]) is not (other := sets[second]):
                found |= other
                sets.update(dict.fromkeys(other, found))
        return list({id(found): found for found in sets.values()}.values())


class Pairs:
    """Symbols as numbers, and what two of them make: a piece is its id, a character that is no piece comes behind all ids."""

    def __init__(self, pieces: Pieces):
        known = len(pieces.texts)
        self.symbols = np.arange(known, known + POINTS)
        for piece, i in pieces.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        self.width = known + POINTS + 1
        places = {score: place << PLACE for place, score in enumerate(sorted(set(pieces.rank.values())))}
        number = pieces.ids | {c: int(self.symbols[ord(c)]) for c in set("".join(pieces.ids))}
        joins = sorted((number[piece[:k]] * self.width + number[piece[k:]], places[pieces.rank[piece]], i)
                       for piece, i in pieces.ids.items() for k in range(1, len(piece)) if piece[:k] in number and piece[k:] in number)
        #: Two symbols as one number, the place of their piece's score among all scores, its id.
        self.both, self.scores, self.joined = np.array([*joins, (NEVER, NEVER, 0)]).T.copy()

    def of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of pairs of symbols and the ids of what they make; -1 is no symbol."""
        wanted = left * self.width + right
        at = np.searchsorted(self.both, wanted)
        return np.where(self.both[at] == wanted, self.scores[at], NEVER), self.joined[at]


class Encoder:
    """Encodes texts by one model and remembers short parts."""

    def __init__(self, model: bytes):
        self.pieces = Pieces(model)
        self.pairs = Pairs(self.pieces)
        self.parts = Remembered()
        self.new: list[tuple[str, bytes]] = []  # parts encoded since the last check
        self.between, self.front = self.encoded(self.pieces.apart), self.encoded(SPACE)
        sets = "".join(f"[{''.join(map(re.escape, sorted(found)))}]+|" for found in self.pieces.together())
        self.part = re.compile(f"(?s){SPACE}*(?:{sets}[^{SPACE}])|{SPACE}+" if self.pieces.cuts_at_blanks else "(?s).+")

    def agenda(self, text: str) -> list[str]:
        """Symbols of a text after all merges; the agenda of a short text is a row of scores in order of place, of a long one a heap."""
        return self.agenda_list(text) if len(text) <= self.parts.longest else self.agenda_heap(text)

    def agenda_list(self, text: str) -> list[str]:
        return self.named(self.agendas([text])[0])

    def named(self, symbols: np.ndarray) -> list[str]:
        texts, known = self.pieces.texts, len(self.pieces.texts)
        return [texts[i] if i < known else chr(i - known) for i in symbols.tolist()]

    def agendas(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of short texts after all merges, one text behind the other, and how many each has; in every step, each text merges its best pair."""
        lengths = np.array(list(map(len, texts)))
        places, n, pair = int(lengths.max()), len(texts), self.pairs.of
        symbols = np.full((places + 2, n), -1)  # a column for each text, nothing above and below it
        symbols[1:-1].T[np.arange(places) < lengths[:, None]] = self.pairs.symbols[np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")]
        scores, joined = np.full(symbols.shape, NEVER), np.zeros_like(symbols)
        scores[:-1], joined[:-1] = pair(symbols[:-1], symbols[1:])
        scores[:-1] += np.where(scores[:-1] == NEVER, 0, np.arange(places + 1)[:, None])
        symbols, scores, joined = symbols.ravel(), scores.ravel(), joined.ravel()
        cells = np.arange(symbols.size)
        before, after = cells - n, cells + n
        while True:
            best = scores.reshape(-1, n).min(axis=0)  # the leftmost of the best
            column = np.flatnonzero(best != NEVER)
            if not column.size:
                break
            left = (best[column] & (1 << PLACE) - 1) * n + column
            right = after[left]
            follower, leader = after[right], before[left]
            symbols[left], symbols[right], scores[right] = joined[left], -1, NEVER
            after[left], before[follower] = follower, left
            changed = np.concatenate([leader, left])
            found, joined[changed] = pair(symbols[changed], symbols[np.concatenate([left, follower])])
            scores[changed] = found + np.where(found == NEVER, 0, changed // n)
        left = symbols.reshape(-1, n).T
        return left[left >= 0], (left >= 0).sum(axis=1)

    def agenda_heap(self, text: str) -> list[str]:
        rank = self.pieces.rank
        symbols: list[str | None] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        open_pairs = [(rank[pair], i, pair) for i in range(n - 1) if (pair := text[i:i + 2]) in rank]
        heapq.heapify(open_pairs)
        while open_pairs:
            _, left, pair = heapq.heappop(open_pairs)
            first = symbols[left]
            if first is None or len(first) >= len(pair) or (right := after[left]) >= n or first + symbols[right] != pair:
                continue  # one of both has been merged with another since
            symbols[left], symbols[right] = pair, None
            after[left] = follower = after[right]
            if follower < n:
                before[follower] = left
                joined = pair + symbols[follower]
                if joined in rank:
                    heapq.heappush(open_pairs, (rank[joined], left, joined))
            leader = before[left]
            if leader >= 0:
                joined = symbols[leader] + pair
                if joined in rank:
                    heapq.heappush(open_pairs, (rank[joined], leader, joined))
        return [s for s in symbols if s is not None]

    def encoded(self, part: str) -> bytes:
        """The ids of one part as little-endian 32-bit integers."""
        return self.ids_of(self.agenda(part))

    def ids_of(self, symbols: list[str]) -> bytes:
        ids, fallback = self.pieces.ids, self.pieces.byte_ids
        try:
            return array("i", map(ids.__getitem__, symbols)).tobytes()
        except KeyError:
            return array("i", itertools.chain.from_iterable((ids[s],) if s in ids else map(fallback.__getitem__, s.encode()) for s in symbols)).tobytes()

    def runs(self, part: str) -> Iterator[str]:
        """A long part, cut between characters that no piece holds side by side."""
        start, known = 0, self.pieces.side_by_side
        for i in range(1, len(part)):
            if part[i - 1:i + 1] not in known:
                yield part[start:i]
                start = i
        yield part[start:]

    def encoded_short(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Short parts with their ids, those of about one length together."""
        parts = sorted(parts, key=len)
        for start in range(0, len(parts), SIDE):
            some = parts[start:start + SIDE]
            symbols, counts = self.agendas(some)
            ends = np.cumsum(counts)
            known = symbols < len(self.pieces.texts)
            whole = np.logical_and.reduceat(known, ends - counts)
            raw = symbols.astype("<i4").tobytes()
            for part, begin, end, pieces in zip(some, (ends - counts).tolist(), ends.tolist(), whole.tolist()):
                yield part, raw[4 * begin:4 * end] if pieces else self.ids_of(self.named(symbols[begin:end]))

    def learned(self, parts: set[str]) -> dict[str, bytes]:
        """The ids of parts that are not at hand."""
        known, found = self.parts, {}
        cut = {part: list(self.runs(part)) for part in parts if len(part) > known.longest}
        runs = set(itertools.chain.from_iterable(cut.values()))
        short = []
        for part in (parts - cut.keys()) | runs:
            ids = known.recall(part) or known.get(part)
            if ids is not None:
                found[part] = ids
            elif len(part) > known.longest:
                found[part] = self.encoded(part)
            else:
                short.append(part)
        for part, ids in self.encoded_short(short):
            found[part] = known.keep(part, ids)
            if part in parts:
                self.new.append((part, ids))
        for part, pieces in cut.items():
            found[part] = b"".join([found[run] for run in pieces])
            self.new.append((part, found[part]))
        return found

    def check(self, processor: sentencepiece.SentencePieceProcessor) -> None:
        """Put every part that was encoded since the last check to the library, many in a text with a character between them that joins nothing."""
        apart, between, front = self.pieces.apart, self.between, self.front
        some = [self.new[start:start + JOINED] for start in range(0, len(self.new), JOINED)]
        wanted = processor.encode([apart.join(["", *(part for part, _ in new)]) for new in some], num_threads=1, return_type="numpy")
        for new, want in zip(some, wanted):
            if between.join([front, *(ids for _, ids in new)]) != want.tobytes():
                alone = ((part, processor.encode(apart + part)) for part, _ in new)
                wrong = [part for (part, ids), (_, want) in zip(new, alone) if front + between + ids != np.array(want, "<i4").tobytes()]
                raise ValueError(f"the sentencepiece library encodes {(wrong or [part for part, _ in new])[0]!r} otherwise")
        self.new = []

    def ids(self, text: str) -> bytes:
        """The ids of a whole text as little-endian 32-bit integers."""
        return self.ids_of_all([text])[0]

    def ids_of_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text; texts are cut and what is new in them is encoded together."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            end, characters = start + 1, len(texts[start])
            while end < len(texts) and (characters := characters + len(texts[end])) <= CHARACTERS:
                end += 1
            out += self.cut_and_encoded(texts[start:end])
            start = end
        return out

    def cut_and_encoded(self, texts: list[str]) -> list[bytes]:
        recall, cut, out = self.parts.get, self.part.findall, []
        for text in texts:
            parts = cut(SPACE + text.replace(" ", SPACE)) if text else []
            ids = list(map(recall, parts))
            gaps = [i for i, known in enumerate(ids) if known is None]
            out.append((ids, gaps, [parts[i] for i in gaps]))
        new = self.learned(set(itertools.chain.from_iterable(parts for _, _, parts in out)))
        for ids, gaps, parts in out:
            for i, part in zip(gaps, parts):
                ids[i] = new[part]
        return [b"".join(ids) for ids, _, _ in out]


class Decoder:
    """Text from ids, one by one: bytes wait until they make a character; the blank in front is dropped."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.bytes = codecs.getincrementaldecoder("utf-8")("each_byte")
        self.started = False

    def push(self, token: int) -> str:
        kind = self.pieces.types[token]
        if kind == BYTE:
            out = self.bytes.decode(self.pieces.bytes[token])
            self.started = True
            return out
        out = self.bytes.decode(b"", True)
        self.bytes.reset()
        if kind == CONTROL:
            return out
        if kind == UNKNOWN:
            self.started = True
            return out + " ⁇ "
        piece = self.pieces.texts[token]
        if not self.started and piece.startswith(SPACE):
            piece = piece[1:]
        self.started = True
        return out + piece.replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        self.bytes.reset()
        self.started = False
        return "".join(map(self.push, ids)) + self.bytes.decode(b"", True)


def decoded(pieces: Pieces, ids: list[int]) -> str:
    """The whole text at once where its bytes are a text; else piece by piece."""
    table = pieces.bytes
    try:
        text = b"".join([table[i] for i in ids]).decode()
    except UnicodeDecodeError:
        return Decoder(pieces).decode(ids)
    if not ids or min(ids) <= max(i for i, t in enumerate(pieces.types[:8]) if t in (UNKNOWN, CONTROL)):
        return Decoder(pieces).decode(ids)
    return text[1:] if pieces.texts[ids[0]].startswith(SPACE) and pieces.types[ids[0]] == NORMAL else text


@functools.lru_cache(maxsize=2)
def encoder(model: bytes) -> Encoder:
    """One for each Python worker, which keeps what it has encoded for its next task."""
    return Encoder(model)


@functools.lru_cache(maxsize=2)
def library(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def model_file(path: str | None = None) -> bytes:
    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def encode_and_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row, whole texts.

    With each Arrow batch, every part that it was the first to need is put to the
    library too; ids that differ end the job. A missing text is an empty one: no
    ids, an empty text. Each row is on its own, so repeated rows and ids, missing
    ids and empty tables need no rule. What a worker remembers is bounded; beside
    it, it holds one batch of texts, and the symbols of the longest part that
    cannot be cut.
    """
    model = docs.sparkSession.sparkContext.broadcast(model_file(path))  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, processor = encoder(model.value), library(model.value)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                texts = batch.column("text").to_pylist()
                ids = [np.frombuffer(i, "<i4") for i in encode.ids_of_all(texts)]
                back = [decoded(encode.pieces, i.tolist()) for i in ids]
                encode.check(processor)
                offsets = np.array([0, *itertools.accumulate(map(len, ids))], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, np.concatenate(ids)), pa.array(back, pa.string())], ["doc_id", "ids", "decoded"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
