"""Harmonic packing of token sequences.

A sequence of 2048 tokens is shared by pieces of one class: class c takes pieces
of at most ``size`` tokens and puts ``2048 // size`` of them into each bin. A
document is cut into full sequences, and its rest into at most three pieces
that nearly fill their class. Bins need no look at other pieces, only a count,
so workers (hash groups of pieces, as many as a class needs) fill them each on
its own. What is left over in the workers' last bins goes through the same step
with fewer workers, an eighth as many pieces each time, until one worker per
class is left; the last part-filled bins, one for each class, share sequences.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmill.llm.common import ids_and_texts
from eventmill.session import written

CAPACITY = 2048
END_ID = 1
#: Tokens of padding that a piece may cause, and pieces that a document's rest may be cut into.
SLACK, PIECES = 4, 3
#: A worker gets so many bins of a class at least, and so many pieces.
BINS, ROWS = 8, 256
ROUNDS = 64


def class_sizes(capacity: int = CAPACITY) -> list[int]:
    """Largest piece of each class, falling: capacity / k for k up to 32, then an eighth smaller each down to 1."""
    sizes = [capacity // k for k in range(1, 33) if capacity // k]
    while sizes[-1] > 1:
        sizes.append(min(sizes[-1] - 1, sizes[-1] * 7 // 8))
    return list(dict.fromkeys(sizes))


def cut(tokens: int, sizes: list[int]) -> list[int]:
    """Lengths of the pieces of a document, in order: full sequences, then its rest."""
    whole, rest = divmod(tokens, sizes[0])
    lengths = [sizes[0]] * whole
    for left in range(PIECES, 0, -1):
        if not rest:
            break
        fits = next(size for size in reversed(sizes) if size >= rest)
        take = rest if left == 1 or fits - rest <= SLACK else next(size for size in sizes if size <= rest)
        lengths.append(take)
        rest -= take
    return lengths


class Tokens:
    """Ids of whole texts, as the tokenizer file gives them: its merges are the ranks of its vocabulary."""

    def __init__(self, model: str):
        described = json.loads(model)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the rest follow from 256
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(letters[c] for c in token): i for token, i in described["model"]["vocab"].items()}
        self.encoding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={t["content"]: t["id"] for t in described["added_tokens"]})

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


@functools.lru_cache(maxsize=2)
def tokenizer(model: str) -> Tokens:
    """One for each Python worker."""
    return Tokens(model)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the pieces of each row; every document has its end id at least."""
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file
    sizes = class_sizes(capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = tokenizer(model.value), END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = memoryview(tokens.ids(text.as_py()) + end)
                n, start = len(ids) // 4, 0
                for length in cut(n, sizes):
                    rows.append((doc, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n))
                    start += length
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def share_tails(tails: dict[int, int], capacity: int) -> dict[int, tuple[int, int]]:
    """For each class with a part-filled bin of so many tokens: (the class whose sequence it joins, its offset there). First fit, largest first."""
    shared: list[tuple[list[int], int]] = []  # the classes and tokens of a sequence
    found = {}
    for cls, tokens in sorted(tails.items(), key=lambda x: (-x[1], x[0])):
        home = next((i for i, (_, filled) in enumerate(shared) if filled + tokens <= capacity), len(shared))
        classes, filled = shared[home] if home < len(shared) else ([], 0)
        shared[home:home + 1] = [([*classes, cls], filled + tokens)]
        found[cls] = (shared[home][0][0], filled)
    return found


def pack(cut_up: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces. Only counts of the classes (some 50 rows) come to the driver.

    A round numbers the pieces of each (class, worker) and sums up lengths along
    each bin in the same stage; full bins are done, the rest goes on.
    """
    sizes = class_sizes(capacity)
    n_classes = len(sizes)
    tops = F.array(*map(F.lit, reversed(sizes)))  # the class of a piece: the smallest that holds it
    cls = n_classes - 1 - F.array_position(F.transform(tops, lambda size: size >= F.col("length")), True).cast("int") + 1
    rest = written(cut_up.withColumn("cls", cls), "pieces")
    in_order = [F.col(c) for c in ("doc_id", "start", "ids_crc32", "length")]
    output = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    placed = None
    for step in range(ROUNDS):
        counts = {r.cls: r.n for r in rest.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}
        per_bin = {c: capacity // sizes[c] for c in counts}
        workers = {c: max(1, n // max(BINS * per_bin[c], ROWS)) for c, n in counts.items()}
        plan = F.array(*(F.struct(F.lit(workers.get(c, 1)).cast("long").alias("workers"), F.lit(per_bin.get(c, 1)).cast("long").alias("per_bin"))
                         for c in range(n_classes)))
        rule = plan[F.col("cls")]
        group = Window.partitionBy("cls", "worker")
        numbered = rest.withColumn("worker", F.pmod(F.xxhash64(F.lit(step), "doc_id", "start", "ids_crc32"), rule["workers"])).withColumns({
            "rank": F.row_number().over(group.orderBy(*in_order)) - 1, "n": F.count(F.lit(1)).over(group)})
        numbered = numbered.withColumns({"bin": F.floor(F.col("rank") / rule["per_bin"]), "full": F.floor(F.col("n") / rule["per_bin"])})
        along = Window.partitionBy("cls", "worker", "bin").orderBy(*in_order).rowsBetween(Window.unboundedPreceding, 0)
        number = ((F.col("worker") + rule["workers"] * F.col("bin")) * n_classes + F.col("cls")) * ROUNDS + step
        numbered = written(numbered.select(
            *rest.columns, (F.col("bin") < F.col("full")).alias("full"), number.cast("long").alias("sequence_id"),
            (F.sum("length").over(along) - F.col("length")).alias("offset")), "packed")
        full, left = numbered.where("full").select(*output), numbered.where("NOT full")
        placed = full if placed is None else placed.unionAll(full)
        if all(n == 1 for n in workers.values()):
            break
        rest = left.select(*rest.columns)
    tails = {r.cls: r.n for r in left.groupBy("cls").agg(F.sum("length").alias("n")).collect()}
    places = share_tails(tails, capacity)
    home = F.array(*(F.lit(places.get(c, (c, 0))[0]).cast("long") for c in range(n_classes)))[F.col("cls")]
    base = F.array(*(F.lit(places.get(c, (c, 0))[1]).cast("long") for c in range(n_classes)))[F.col("cls")]
    shared = left.withColumns({"sequence_id": -1 - home, "offset": F.col("offset") + base}).select(*output)
    return placed.unionAll(shared)


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every row of ``docs``.

    A missing or empty text is a document of its end id alone. Rows that repeat
    are packed each on its own; a missing id is kept. An empty table gives none.
    """
    return pack(pieces(docs, path, capacity), capacity)
