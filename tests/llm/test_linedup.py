"""Line windows against a plain pass over the corpus, and against SQL."""

import compare
import helpers
import pytest
from conftest import MEDIUM, SMALL

from eventmill.llm import linedup
from eventmill.llm.oracle import ORACLES
from eventmill.llm.queries import QUERIES


def plain(rows):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: r[0]):
        lines, covered = (text or "").split("\n"), set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p:p + 3])
            if not "".join(window).strip(" "):
                continue
            if window in seen:
                covered |= {p, p + 1, p + 2}
            seen.add(window)
        kept = "\n".join(line for p, line in enumerate(lines) if p not in covered)
        out.append((i, text if not covered else kept, len(lines) if text else 0, len(covered)))
    return out


def test_awkward_rows(spark):
    rows = [(i, t) for i, t in dict(helpers.AWKWARD).items() if i is not None]
    docs = helpers.documents(spark, rows).withColumnRenamed("n", "n_removed")
    got = linedup.drop_repeated_lines(docs)
    assert got.columns == [c for c in docs.columns if c != "n_removed"] + ["n_lines_before", "n_removed"]
    assert helpers.by_id(got.select("doc_id", "text", "n_lines_before", "n_removed").collect()) == helpers.by_id(plain(rows))


def test_repeated_and_missing_ids(spark):
    text = "a\nb\nc\nd"
    docs = helpers.documents(spark, [(2, text), (2, text), (3, text), (None, "a\nb\nc\nz"), (None, None)])
    got = sorted(((r.doc_id or 0), r.text or "", r.n_removed) for r in linedup.drop_repeated_lines(docs).collect())
    assert got == [(0, "", 0), (0, "a\nb\nc\nz", 0), (2, "d", 3), (2, "d", 3), (3, "", 4)]
    assert linedup.drop_repeated_lines(helpers.documents(spark, [])).collect() == []


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_sql(spark, folder):
    name = "op10_line_windows"
    assert compare.spark_rows(QUERIES[name](spark, folder)) == compare.sql_rows(compare.connection(folder), ORACLES[name])
