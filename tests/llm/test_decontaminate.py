import hashlib
import random
import re

from llm_cases import ODD
from quarry.llm.decontaminate import contamination, decontaminate

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def plain(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(n, {}).setdefault(tuple(w[s:s + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n, table in windows.items():
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in table:
                    hit.update(range(s, s + n))
                    found |= table[tuple(w[s:s + n])]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def cases():
    rng = random.Random(11)
    vocab = ["a", "b", "c", "É", "é", "K9", "x-y", "日本", "the", "of"]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    items = [(i, prose(rng.randint(13, 40))) for i in range(25)]
    docs = []
    for i in range(120):
        t = prose(rng.randint(0, 60))
        if i % 3 == 0:  # a piece of an item, from well under to the whole
            w = rng.choice(items)[1].split(" ")
            a = rng.randint(0, len(w) - 1)
            t += ", " + " ".join(w[a:a + rng.randint(5, 40)]).upper().replace("É", "É") + " " + prose(5)
        docs.append((1000 + i, t))
    return docs, items


def run(make_docs, ckpt, docs, items):
    bench = ckpt.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, contamination(make_docs(docs, extra=["words", "n_hit", "prints"]), bench).collect()),
                  key=repr)


def test_long_items(make_docs, ckpt):
    docs, items = cases()
    want = plain(docs, items)
    assert run(make_docs, ckpt, docs, items) == sorted(want, key=repr)
    assert any(r[5] for r in want) and any(not r[5] for r in want)


def test_short_items_and_odd_rows(make_docs, ckpt):
    docs = ODD + [(50, "a b c d e f " * 30), (51, "É a b"), (52, "x one y"), (53, "a " * 40), (None, "one")]
    items = [(1, "one"), (2, "a b c d e f"), (2, "a b c d e f"), (3, ""), (4, None), (None, "no id"), (5, "É A b"),
             (6, "a " * 12), (7, "b c d"), (8, "word " * 13)]
    assert run(make_docs, ckpt, docs, items) == sorted(plain(docs, items), key=repr)


def test_the_rows_that_stay(make_docs, ckpt):
    docs, items = cases()
    bench = ckpt.createDataFrame(items, "item_id long, text string")
    left = decontaminate(make_docs(docs, extra=["label"]), bench)
    assert left.columns[-1] == "label"
    assert sorted(r.doc_id for r in left.collect()) == [r[0] for r in plain(docs, items) if not r[5]]


def test_empty(make_docs, ckpt):
    bench = ckpt.createDataFrame([], "item_id long, text string")
    assert contamination(make_docs([]), bench).collect() == []
    got = contamination(make_docs([(1, "a b")]), bench).collect()
    assert [(r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got] == [(2, 0, 0, False)]


def test_no_python_in_the_plan(make_docs, ckpt, capsys):
    bench = ckpt.createDataFrame(cases()[1], "item_id long, text string")
    contamination(make_docs(cases()[0]), bench).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
