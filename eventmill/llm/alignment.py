"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A gives its tokens character offsets, tokenizer B the spans of its
pieces. Characters where tokens of both end are the coarse cuts. A token that
ends within a character (a byte piece, or a part of a multibyte character) shows
by overlapping or empty spans; such tokens are placed by the bytes they decode
to, and bytes where tokens of both end are further cuts.

Both tokenizers start a new token at a single blank between two visible
characters, so a text is a chain of parts that are aligned apart; short ones
once per worker.

One of two linked tokens ends with the other's bytes. So the id pairs that can
be linked at all are bounded by the two vocabularies (``most_pairs``), however
large the corpus is, and the table of their counts may be broadcast.
"""

from __future__ import annotations

import functools
import itertools
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventmill.llm.common import Remembered, ids_and_texts
from eventmill.llm.subwords import SPACE, Pieces, library, model_file
from eventmill.session import written

#: Texts per batch that goes out, and parts that are aligned in one go.
BATCH, PARTS = 256, 20_000
#: Parts that are encoded as one string.
SIDE_BY_SIDE = 50
#: Pairs up to which their table is broadcast (16 bytes each); the two vocabularies here cannot have as many. Beyond, the join shuffles.
MOST_BROADCAST = 1_000_000


class Aligner:
    """Aligns texts by one pair of models; ``None`` stands for a text whose tokens do not give its bytes back."""

    def __init__(self, a_model: str, b_model: bytes):
        described = json.loads(a_model)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the rest follow from 256
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.a = Tokenizer.from_str(a_model)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b: sentencepiece.SentencePieceProcessor = library(b_model)
        pieces = Pieces(b_model)
        vocabulary = described["model"]["vocab"]
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.a_bytes[i] = bytes(letters[c] for c in token)
        self.b_bytes = pieces.bytes
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in side]) for side in (self.a_bytes, self.b_bytes))
        by_words = described["pre_tokenizer"] == described["pre_tokenizer"] | {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False} and not described["normalizer"]
        #: A single blank between two visible characters starts a part.
        self.cut_at = regex.compile(r"(?<=\S)(?= \S)") if by_words and pieces.cuts_at_blanks else None
        #: A blank that starts no part, as it is not between visible characters.
        self.other_blank = regex.compile(r" \s|\s | \Z")
        self.known = Remembered()
        names_a, names_b = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(len(self.b_bytes))]
        #: A token's id and what follows it: of A within and at the end of a group, then of B.
        self.printed = [f"{i}{mark}" for names, marks in ((names_a, ",|"), (names_b, ",;")) for i in names for mark in marks]

    def parts(self, text: str) -> list[str]:
        """The parts of a text that begins with a blank."""
        if not self.cut_at:
            return [text]
        if self.other_blank.search(text):
            return self.cut_at.split(text)
        return [" " + word for word in text[1:].split(" ")]  # every blank stands between visible characters

    def strings(self, parts: list[str]) -> list[str]:
        """The parts in a row as strings to encode: many side by side, where a blank between visible characters keeps them apart."""
        if not self.cut_at:
            return parts
        out, run = [], []
        for part in parts:
            if len(part) < 2 or part[1].isspace() or part[-1].isspace() or SPACE in part:
                out += ["".join(run), part] if run else [part]
                run = []
                continue
            run.append(part)
            if len(run) == SIDE_BY_SIDE:
                out.append("".join(run))
                run = []
        return [*out, "".join(run)] if run else out

    def encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all parts in a row: ids of A with first and end characters, ids of B with ends, and tokens of A and of B per part."""
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        found = self.placed(self.strings(parts))
        n_a, n_b = (np.diff(np.searchsorted(at, ends, "right"), prepend=0) for at in (found[1][:, 1], found[3]))
        stops = [np.cumsum(n) - 1 for n in (n_a, n_b)]
        if n_a.all() and n_b.all() and (found[1][stops[0], 1] == ends).all() and (found[3][stops[1]] == ends).all():
            return *found, n_a, n_b
        if len(parts) == 1:
            return *found, np.array([len(found[0])]), np.array([len(found[2])])
        half = len(parts) // 2  # some part has no token for its end: it is looked for
        first, second = self.encoded(parts[:half]), self.encoded(parts[half:])
        return tuple(np.concatenate([x, y + ends[half - 1] if k in (1, 3) else y]) for k, (x, y) in enumerate(zip(first, second)))

    def placed(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all strings in a row: ids of A with first and end characters, ids of B with ends."""
        flat = itertools.chain.from_iterable
        bases = np.array([0, *itertools.accumulate(map(len, strings))])
        of_a = self.a.encode_batch(strings, add_special_tokens=False)
        a = np.fromiter(flat(e.ids for e in of_a), np.int64)
        spans = np.fromiter(flat(flat(e.offsets for e in of_a)), np.int64).reshape(-1, 2) + np.repeat(bases[:-1], [len(e) for e in of_a])[:, None]
        of_b = self.b.encode([string[1:] for string in strings], num_threads=1, return_type="offset_mapping")
        n_b = [len(e["ids"]) for e in of_b]
        b = np.fromiter(flat(e["ids"] for e in of_b), np.int64)
        b_ends = np.fromiter(flat(flat(e["offsets"] for e in of_b)), np.int64)[1::2] + np.repeat(bases[:-1] + 1, n_b)  # B puts the blank in front itself
        return a, spans, b, b_ends

    def given_back(self, parts: list[str], a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[bool]:
        """Whether the tokens of A and of B give back the bytes of a part."""
        sides = [[table[i] for i in ids.tolist()] for table, ids in ((self.a_bytes, a), (self.b_bytes, b))]
        raw = [part.encode() for part in parts]
        whole, lengths = b"".join(raw), np.array(list(map(len, raw)))
        stops = [np.append(0, np.cumsum(n)) for n in (n_a, n_b)]
        sizes = [np.diff(np.append(0, np.cumsum(table[ids]))[stop]) for table, ids, stop in ((self.a_lengths, a, stops[0]), (self.b_lengths, b, stops[1]))]
        if all(b"".join(side) == whole for side in sides) and all((size == lengths).all() for size in sizes):
            return [True] * len(parts)
        return [all(b"".join(side[stop[i]:stop[i + 1]]) == raw[i] for side, stop in zip(sides, stops)) for i in range(len(parts))]

    def cuts(self, a: np.ndarray, spans: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each cut, the number of A's and of B's tokens before it."""
        a_ends = spans[:, 1]
        a_inside = np.append(spans[1:, 0] < a_ends[:-1], False)  # the next token shares its last character
        b_inside = np.append(False, b_ends[1:] == b_ends[:-1])  # it has no characters of its own
        a_at, b_at = np.flatnonzero(~a_inside), np.flatnonzero(~b_inside)
        _, i, j = np.intersect1d(a_ends[a_at], b_ends[b_at], assume_unique=True, return_indices=True)
        i, j = a_at[i], b_at[j]
        if a_inside.any() and b_inside.any():  # tokens that end within a character are placed by their bytes
            a_at, b_at = np.flatnonzero(a_inside), np.flatnonzero(b_inside)
            _, k, l = np.intersect1d(np.cumsum(self.a_lengths[a])[a_at], np.cumsum(self.b_lengths[b])[b_at], assume_unique=True, return_indices=True)
            i, j = np.sort(np.append(i, a_at[k])), np.sort(np.append(j, b_at[l]))
        return i + 1, j + 1

    def aligned(self, parts: list[str]) -> list[tuple[int, int, str, bytes] | None]:
        """Of each part: tokens of A and of B, the groups as text, and the linked id pairs (A's in the upper half) as 64-bit integers."""
        if not parts:
            return []
        a, spans, b, b_ends, n_a, n_b = self.encoded(parts)
        good = self.given_back(parts, a, b, n_a, n_b)
        if not all(good):
            rest = iter(self.aligned([part for part, ok in zip(parts, good) if ok]))
            return [next(rest) if ok else None for ok in good]
        i, j = self.cuts(a, spans, b, b_ends)
        # each token's place in the text form: A's behind the B tokens of all groups before, B's behind the A tokens up to its own
        place_a = np.arange(len(a)) + np.repeat(np.append(0, j[:-1]), np.diff(i, prepend=0))
        place_b = np.arange(len(b)) + np.repeat(i, np.diff(j, prepend=0))
        codes = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[i - 1] = last_b[j - 1] = 1
        codes[place_a] = 2 * a + last_a
        codes[place_b] = 2 * (len(self.a_bytes) + b) + last_b
        printed = self.printed
        tokens = [printed[c] for c in codes.tolist()]
        links = (a[i - 1] << 32 | b[j - 1]).astype("<i8").tobytes()
        stops = np.append(0, np.cumsum(n_a + n_b)).tolist()
        link_stops = (8 * np.append(0, np.searchsorted(i, np.cumsum(n_a), "right"))).tolist()
        return [(x, y, "".join(tokens[s:e]), links[f:t])
                for x, y, s, e, f, t in zip(n_a.tolist(), n_b.tolist(), stops, stops[1:], link_stops, link_stops[1:])]

    def texts(self, texts: list[str]) -> list[tuple[int, int, str, np.ndarray] | None]:
        """As ``aligned``, of whole texts with a blank in front; parts that are not remembered are aligned in one go."""
        known = self.known
        in_parts = [self.parts(" " + text) if text else [] for text in texts]
        here = dict.fromkeys(itertools.chain.from_iterable(in_parts))  # each part of the batch is looked up once
        new = []
        for part in here:
            if (value := known.get(part)) is not None or (value := known.recall(part)) is not None:
                here[part] = value
            else:
                new.append(part)
        for start in range(0, len(new), PARTS):
            some = new[start:start + PARTS]
            for part, found in zip(some, self.aligned(some)):
                here[part] = known.keep(part, found or ())
        out = []
        for parts in in_parts:
            found = list(map(here.__getitem__, parts))
            if not parts or not all(found):
                out.append(None)
                continue
            n_a, n_b, groups, links = zip(*found)
            out.append((sum(n_a), sum(n_b), "".join(groups)[:-1], np.frombuffer(b"".join(links), "<i8")))
        return out


def most_pairs(a_tokens: list[bytes], b_tokens: list[bytes]) -> int:
    """Id pairs of which one ends with the other's bytes."""
    a_count, b_count = Counter(a_tokens), Counter(b_tokens)
    a_ends_so = sum(n * b_count[t[i:]] for t, n in a_count.items() for i in range(len(t)))
    return a_ends_so + sum(n * a_count[t[i:]] for t, n in b_count.items() for i in range(1, len(t)))


@functools.lru_cache(maxsize=1)
def aligner(a_model: str, b_model: bytes) -> Aligner:
    """One for each Python worker, which keeps what it has aligned for its next task."""
    return Aligner(a_model, b_model)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, groups, links array<struct<pair long, n int>>) of every row, whole texts.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of A, then of B, of the bytes
    between two cuts. ``links`` holds each different pair of ids that end
    together, A's in the upper 32 bits, and how often. ``row`` tells repeated
    rows apart. A missing or empty text, or one that the tokens of A or B do not
    give back byte for byte, has no tokens. Repeated rows, missing ids and empty
    tables need no rule.
    """
    with open(a_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        models = docs.sparkSession.sparkContext.broadcast((file.read(), model_file(b_path)))  # two vocabulary files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align_texts = aligner(*models.value).texts
        row = TaskContext.get().partitionId() << 33
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                found = [f or (0, 0, "", np.zeros(0, "<i8")) for f in align_texts(batch.column("text").to_pylist())]
                links = [np.unique(f[3], return_counts=True) for f in found]
                offsets = np.array([0, *itertools.accumulate(len(pairs) for pairs, _ in links)], np.int32)
                values = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([pairs for pairs, _ in links])), pa.array(np.concatenate([n for _, n in links]).astype(np.int32))], ["pair", "n"])
                counts = [pa.array(c, pa.int64()) for c in zip(*((f[0], f[1], len(f[3])) for f in found))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + batch.num_rows), pa.int64()), batch.column("doc_id"), *counts, pa.array([f[2] for f in found], pa.string()),
                     pa.ListArray.from_arrays(offsets, values)], ["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "links"])
                row += batch.num_rows

    return ids_and_texts(docs).mapInArrow(
        run, "row long, doc_id long, n_a long, n_b long, n_groups long, groups string, links array<struct<pair: long, n: int>>")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, total, best) over all documents; ``links`` has (pair, n). ``best``: no other id of A is linked oftener with its id of B."""
    totals = links.groupBy("pair").agg(F.sum("n").alias("total"))
    totals = written(totals, "pair_counts").withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    return totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def summed_up(aligned: DataFrame) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``align``.

    The counts are looked up in a table that the vocabularies bound, so the
    links of a row meet only the partial sums of their own row and no link is
    shuffled.
    """
    keys = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    rows = written(aligned.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))).select(*keys, "links"), "aligned")
    counts = written(pair_counts(rows.select(F.inline("links"))), "pairs")
    few = counts.count() <= MOST_BROADCAST
    links = rows.select(*keys, F.inline_outer("links"))
    return links.join(F.broadcast(counts) if few else counts, "pair", "left").groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.sum(F.when(F.col("best"), F.col("n"))), F.lit(0)).cast("long").alias("n_best"),
        F.coalesce(F.sum(F.col("n") * F.col("total")), F.lit(0)).cast("long").alias("count_sum")).drop("row")
