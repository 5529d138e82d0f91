import numpy as np
import pyarrow as pa
import pytest

from tripflow.llm.text import blocks, span_hash

TEXTS = [None, "", "one", " two\twords \n", "é\x0bß\x0c\r日本", "\n\na\n\nb c\n", "x" * 50, None, "no\x85break here\x1cnor here", "tail "]


def words(b):
    start, end, first = b.words()
    raw = b.buf.tobytes()
    return [[raw[s:e] for s, e in zip(start[i:j], end[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_and_lines(size, kind):
    column = pa.array(["skipped", *TEXTS], kind).slice(1)
    got_words, got_lines, rows = [], [], 0
    for b in blocks(column, size):
        assert b.lo == rows
        rows = b.hi
        got_words += words(b)
        start, end, first = b.lines()
        raw = b.buf.tobytes()
        got_lines += [[raw[s:e] for s, e in zip(start[i:j], end[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]
    assert rows == len(TEXTS)
    assert got_words == [(t or "").encode().split() for t in TEXTS]
    assert got_lines == [(t or "").encode().split(b"\n") for t in TEXTS]


def test_equal_spans_have_equal_hashes_wherever_they_stand():
    b = next(blocks(pa.array(["abc abd", "x abc", "abcabc abc"])))
    start, end, _ = b.words()
    h = span_hash(b.prefix_hash(), start, end)
    assert h[0] == h[3] == h[5] and len(np.unique(h)) == 4


def test_no_rows():
    assert list(blocks(pa.array([], pa.string()))) == []
