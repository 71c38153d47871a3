"""Packing: every id in one piece, gapless sequences, little padding."""

import zlib

import helpers
import numpy as np
import public_tokenizers
import pytest
from conftest import MEDIUM
from tokenizers import Tokenizer

from eventmill.llm import packing
from eventmill.llm.common import table

SIZES = packing.class_sizes()


@pytest.mark.parametrize("n", [1, 2, 7, 1023, 1024, 1025, 1500, 2047, 2048, 2049, 9000])
def test_cuts(n):
    lengths = packing.cut(n, SIZES)
    assert sum(lengths) == n and all(1 <= x <= 2048 for x in lengths) and len(lengths) <= n // 2048 + packing.PIECES
    waste = sum(min(s for s in SIZES if s >= x) - x for x in lengths)
    assert waste <= max(8, 0.02 * n)


def check(rows, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sequences = {}
    documents = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        documents.setdefault(r.doc_id, []).append(r)
    for pieces in sequences.values():
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:] + [(sum(n for _, n in pieces), 0)]))
        assert pieces[0][0] == 0 and sum(n for _, n in pieces) <= 2048
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(documents[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return sum(0 if (n := sum(x for _, x in p)) & (n - 1) == 0 else 2048 - n for p in sequences.values())


def test_awkward_rows(spark):
    rows = [(i, t) for i, t in helpers.AWKWARD if i not in (None, 2)] + [(20, "<|endoftext|>a<|endoftext|>")]
    check(packing.packed(helpers.documents(spark, rows)).collect(), dict(rows))
    again = packing.packed(helpers.documents(spark)).collect()
    assert sum(r.length for r in again if r.doc_id == 2) == 2 * sum(r.length for r in again if r.doc_id == 1)
    assert sum(r.start == 0 for r in again if r.doc_id is None) == 2
    assert packing.packed(helpers.documents(spark, [])).collect() == []


def test_little_padding(spark):
    docs = table(spark, MEDIUM, "documents")
    rows = packing.packed(docs).collect()
    padding = check(rows, {r.doc_id: r.text for r in docs.collect()})
    assert padding < 0.01 * sum(r.length for r in rows)


def test_workers_fill_apart(spark, monkeypatch):
    """With few pieces to a worker the leftovers go through several rounds."""
    monkeypatch.setattr(packing, "BINS", 1)
    monkeypatch.setattr(packing, "ROWS", 4)
    pieces = spark.range(3000).selectExpr("id AS doc_id", "0L AS start", "cast(1 + id % 700 AS long) AS length", "id AS ids_crc32", "1L AS doc_tokens")
    rows = packing.pack(pieces).collect()
    assert len(rows) == 3000
    check(rows, {})
