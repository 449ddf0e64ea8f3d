"""Operator 9's short ways: letters and closing marks are not cut by a pattern, ids are looked up, with the results of the long way."""

import numpy as np
import pytest

from tidewater.llm import bpe, rans


def test_letters_and_closing_marks_need_no_pattern(monkeypatch):
    encode = bpe.TextEncoder({}, "", lambda p: p.encode() + b"|")
    texts = ["straße what. ñadoóado, x$$$ a?! (x) über)", "it's don't. a_b x_. 'll. ½. a½. ", "...", "a.b, c-d. é'."]
    want = [b"".join(p.encode() + b"|" for w in bpe.normal(t).split() for q in bpe.runs(w)
                     for p in (bpe.exact_runs(q) if q[0].isalnum() and not q.isascii() else [q])) for t in texts]
    assert [encode(t) for t in texts] == want
    plain = bpe.TextEncoder({}, "", lambda p: p.encode() + b"|")
    real = bpe.runs
    monkeypatch.setattr(bpe, "runs", lambda w: real(w) if not any(map(str.isalpha, w)) else pytest.fail(f"cut by pattern: {w}"))
    assert plain("straße what. ñadoóado, x$$$ a?!") == "straße|what|.|ñadoóado|,|x|$$$|a|?!|".encode()


def test_ids_are_looked_up(monkeypatch):
    ids = np.array([3, 7, 900], dtype=np.int64)
    far = np.array([3, 7, 1 << 31], dtype=np.int64)
    for known, unknown in ((ids, [5, 0, 901, 1 << 31]), (far, [5, 0, (1 << 31) + 1])):
        coder = rans.Coder(16, known, np.array([1, 2, (1 << 16) - 3]))
        data = np.tile(known, 500).astype(np.uint32)
        assert (coder.decode(coder.encode(data)) == data).all()
        for x in unknown:
            with pytest.raises(ValueError):
                coder.encode(np.array([3, x], dtype=np.uint32))
    coder = rans.Coder(16, ids, np.array([1, 2, (1 << 16) - 3]))
    monkeypatch.setattr(rans.np, "searchsorted", lambda *a: pytest.fail("searched"))
    assert len(coder.encode(np.tile(ids, 9).astype(np.uint32)))
