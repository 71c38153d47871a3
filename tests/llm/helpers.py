"""Plain versions of the contracts, and rows with every awkward case."""

from __future__ import annotations

import re

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PROSE = "the quick brown fox jumps over the lazy dog while many small birds sing in old trees near the river bank today"
AWKWARD = [
    (1, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \t\n\x0b "), (6, "one"), (7, PROSE.replace("fox", "cat")), (8, "x" * 30_000), (9, "word " * 30_000),
    (10, "line a\nline b\nline c\nline d"), (11, "top\nline a\nline b\nline c\nend"), (12, "line a\nline b\nline c\nline a\nline b\nline c"),
    (13, "😀 é ñ 中文 \x1f \x85 ́"), (2, PROSE), (None, PROSE), (None, None), (14, "a\r\nb\r\nc\r\n\n\n\n\n\n"), (15, "Ünïcödé ÉÉÉ ΣΑΣ İ"),
]


def documents(spark, rows=AWKWARD):
    """Documents with extra columns whose names operators use themselves."""
    full = [(i, t, "en", "s", len(t or ""), 7, "w", "f", "p") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, n int, words string, fp string, pos string")


def by_id(rows):
    """Rows as sorted tuples, missing ids first."""
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def components(nodes, linked):
    """Smallest reachable node of each, by trying all pairs."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}
