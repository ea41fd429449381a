import re

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import words as W


def spans(text: str) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


TEXTS = ["", None, "one", "  lead and trail ", "a\tb\nc\rd\x0be\x0cf g", "é ü\xa0ñ", "x" * 5000 + " y " + "z" * 3000, "one two", "Two ONE"]


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_equal_words_have_equal_hashes_and_others_differ(monkeypatch, block):
    monkeypatch.setattr(W, "_BLOCK", block)
    offsets, data = W.utf8(pa.array(TEXTS))
    hashes, bounds = W.word_hashes(offsets, data)
    every = [w for t in TEXTS for w in spans(t)]
    assert len(every) == len(hashes) and np.diff(bounds).tolist() == [len(spans(t)) for t in TEXTS]
    known = {}
    for w, h in zip(every, hashes.tolist(), strict=True):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    folded, _ = W.word_hashes(offsets, data, fold=True)
    assert len(set(folded.tolist())) == len({w.lower() if w.isascii() else w for w in every})


def test_hashes_do_not_depend_on_neighbours_or_chunks():
    whole = W.word_hashes(*W.utf8(pa.array(["a b c", "d e"])))[0]
    sliced = W.word_hashes(*W.utf8(pa.chunked_array([pa.array(["zz a b c"]).slice(0, 1), pa.array(["d e"])])))[0]
    assert whole.tolist() == sliced[1:].tolist()
    part = pa.array(["skip", "a b c", "d e"]).slice(1)
    assert W.word_hashes(*W.utf8(part))[0].tolist() == whole.tolist()


def test_windows_stay_inside_rows():
    texts = ["a b c d", "b c d", "", "x", "a b c"]
    hashes, bounds = W.word_hashes(*W.utf8(pa.array(texts)))
    starts = W.window_starts(bounds, 3)
    windows = W.window_hashes(hashes, 3)[starts]
    want = [tuple(t.split()[i:i + 3]) for t in texts for i in range(len(t.split()) - 2)]
    assert len(want) == len(windows)
    assert len(set(want)) == len(set(windows.tolist()))
    assert windows[1] == windows[2] and windows[0] == windows[3]


def test_slices_cover_rows_and_isolate_long_ones():
    offsets = np.array([0, 5, 5, 100, 103, 104])
    got = list(W.slices(offsets, 10))
    assert [r for a, b in got for r in range(a, b)] == list(range(5))
    assert all(offsets[b] - offsets[a] <= 10 or b == a + 1 for a, b in got)
