import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from silverline.llm import flat_text as ft

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZé日 \t\n\x0b-_09[{~", max_size=40)), max_size=8)


def words(text, pattern):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(pattern, low)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_as_the_patterns_say(texts):
    data, offsets = ft.flatten(pa.array(texts, pa.string()))
    for table, pattern in ((ft.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (ft.ALNUM_LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        w = ft.words_of(data, offsets, table)
        got = [[bytes(w.data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first[:-1], w.first[1:])]
        assert got == [words(t, pattern) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab é", min_size=1, max_size=6), min_size=1, max_size=10))
def test_equal_spans_have_equal_hashes(texts):
    data, offsets = ft.flatten(pa.array(texts, pa.string()))
    h = ft.span_hash(ft.prefix_sums(data), offsets[:-1], offsets[1:])
    alone = ft.hash_words([t.encode() for t in texts])
    assert h.tolist() == alone.tolist()
    assert len(set(h.tolist())) == len(set(texts))


def test_blocks_cover_all_rows_and_long_texts():
    texts = ["a" * 10, None, "", "b" * 5000, "c"]
    column = pa.chunked_array([pa.array(texts[:2], pa.string()), pa.array(texts[2:], pa.string())])
    seen = []
    for low, high, data, offsets in ft.blocks(column, limit=100):
        for i in range(high - low):
            seen.append(bytes(data[offsets[i]:offsets[i + 1]]).decode())
    assert seen == [t or "" for t in texts]


def test_windows_stay_within_documents():
    first = np.array([0, 3, 3, 5])
    at, doc = ft.window_starts(first, 2)
    assert at.tolist() == [0, 1, 3] and doc.tolist() == [0, 0, 2]
