"""Fill-in-the-middle against plain string work."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD

from quarry.llm.fim import MARKERS, Marks, fill_in_middle, line_ends, restore_documents


def plain(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if not text or any(m in text for m in MARKERS) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LINES = [(100 + i, "\n".join(["é" * (i % 7), "日本 line", "", "x" * i, "😀"] * (i % 5)) + "\n" * (i % 3))
         for i in range(120)]
MARKED = [(300, "a <P> b"), (301, "<S>\n"), (302, "x\n<M"), (303, "<\nP>"), (304, "<M>"), (305, "\n"), (306, "a\r\nb\rc")]


def _key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 100), (0, 50)])
def test_equals_plain_version(make_docs, rate, spm):
    rows = ODD + LINES + MARKED
    got = fill_in_middle(make_docs(rows), rate=rate, spm=spm).collect()
    assert _key(tuple(r) for r in got) == _key(plain(*r, rate=rate, spm=spm) for r in rows)


def test_digests_and_round_trip(make_docs):
    rows = ODD + LINES + MARKED
    docs = make_docs(rows, extra=["output", "form", "n", "text_", "h"])
    digests = fill_in_middle(docs, with_text=False).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(*(p := plain(*r))[:5], sha(p[5]), sha(r[1] or "")) for r in rows]
    assert _key(tuple(r) for r in digests) == _key(want)
    back = restore_documents(fill_in_middle(docs)).collect()
    assert _key(tuple(r) for r in back) == _key((i, t or "") for i, t in rows)


def test_empty_table_and_bad_markers(make_docs):
    assert fill_in_middle(make_docs([])).collect() == []
    with pytest.raises(ValueError):
        fill_in_middle(make_docs([]), markers=("<A>", "<A>", "<B>"))


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80))
def test_rank_and_select(data):
    raw = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    raw[:len(data)] = np.frombuffer(data.replace(b"\x0b", b"\n"), np.uint8)
    marks = Marks(line_ends(raw.view("<u8")))
    places = np.flatnonzero(raw == 10)
    at = np.arange(len(data) + 1)
    assert marks.rank(at).tolist() == [int((places < i).sum()) for i in at]
    if len(places):
        assert marks.select(np.arange(len(places))).tolist() == places.tolist()
