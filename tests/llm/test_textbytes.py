import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from logweave.llm import textbytes as tb

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x0c\r\x1c\x85é日", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 60))
def test_words_and_lines(values, limit):
    got_words, got_lines = [[] for _ in values], [[] for _ in values]
    for s in tb.slices(pa.array(values, pa.string()), limit):
        for spans, into in ((tb.words(s), got_words), (tb.lines(s), got_lines)):
            for a, b, r in zip(spans.start, spans.end, spans.row, strict=True):
                into[s.first + r].append(s.data[a:b].tobytes().decode())
    assert got_words == [re.findall(r"[^\x20\x09-\x0D]+", v or "") for v in values]
    assert got_lines == [(v or "").split("\n") for v in values]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abé ", max_size=12), min_size=1, max_size=12))
def test_hashes_tell_words_apart(values):
    seen = {}
    for limit in (5, 1000):
        for s in tb.slices(pa.array(values), limit):
            w = tb.words(s)
            for h, a, b in zip(tb.hashes(s.data, w, block=3 if limit == 5 else 1000).tolist(), w.start, w.end, strict=True):
                word = s.data[a:b].tobytes()
                assert seen.setdefault(word, h) == h == int(tb.text_hash(word))
    assert len(set(seen.values())) == len(seen)


def test_windows_stay_within_rows():
    s = next(tb.slices(pa.array(["a b c d", "", "a b c", "x a b c"])))
    w = tb.words(s)
    h, at = tb.windows(tb.hashes(s.data, w), w.row, 3)
    assert at.tolist() == [0, 1, 4, 7, 8] and h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


def test_slices_of_arrays_with_offsets():
    a = pa.array(["skip", "one", None, "two words"]).slice(1)
    assert [s.text(k) for s in tb.slices(a) for k in range(s.rows)] == [b"one", b"", b"two words"]
    assert list(tb.slices(pa.array([], pa.string()))) == []
    assert np.array_equal(next(tb.slices(pa.array(["é a"], pa.large_string()))).offs, [0, 4])
