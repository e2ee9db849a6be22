import hashlib
import random
import re

import pytest

from llm_cases import ODD
from quarry.llm.pii import find_personal_data, personal_data_digest


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c))
               for i, c in enumerate(d[::-1])) % 10 == 0


PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)]


def plain(text):
    return sorted((m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(PLAIN)
                  for m in re.finditer(p, text or "") if ok(m[0]))


def noise(rng):
    bits = ["a@b.com", "_x@y.org", "1.2.3.4", ".5", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+1 (555) 123-4567", "+", "@", " ", "é😀", "0.0.0.0.0", "a.b@", "00012.003.1.255", "((", "-", "12", "\n"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))


def test_base_spans_against_plain_search(make_docs):
    rng = random.Random(9)
    rows = list(ODD) + [(100 + i, noise(rng)) for i in range(400)]
    rows += [(1000, "1" * 20_000), (1001, "a" * 30_000 + "@" + "b.c " * 3), (1002, "+1" + "(" * 5000 + " 2345678"),
             (1003, " ".join(f"u{i}@m.io" for i in range(1500)))]
    got = personal_data_digest(make_docs(rows, extra=["found", "spans", "hits_email"])).collect()
    assert len(got) == len(rows)
    want = {(i, t): plain(t) for i, t in rows}
    for r in got:
        options = [w for (i, _), w in want.items() if i == r.doc_id]
        joined = [",".join(f"{n}:{a}:{b}" for a, _, n, b in w) for w in options]
        assert r.base_sha256 in [hashlib.sha256(j.encode()).hexdigest() for j in joined]
        counts = [tuple(sum(s[2] == n for s in w) for n, _, _ in PLAIN) for w in options]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) in counts


@pytest.mark.parametrize("text, kinds", [
    ("IBAN DE89 3704 0044 0532 0130 00.", ["iban"]),
    ("x GB82WEST12345698765432 DE89370400440532013001", ["iban"]),  # the second fails mod-97
    ("my ssn is 123-45-6789", ["ssn"]),
    ("part 123-45-6789 of the list", []),  # no context, no checksum: too low a score
    ("pay by visa 4111111111111111", ["card"]),
])
def test_added_kinds(make_docs, text, kinds):
    found = find_personal_data(make_docs([(1, text)])).first().found
    assert [s.kind for s in found] == kinds
    assert all(text[s.start:s.end] == s.text for s in found)


def test_context_raises_the_score(make_docs):
    a, b = (find_personal_data(make_docs([(1, t)])).first().found[0].score
            for t in ("from 10.0.0.1 on", "server address 10.0.0.1"))
    assert b > a


def test_no_python_in_the_plan(make_docs, capsys):
    personal_data_digest(make_docs(ODD)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty(make_docs):
    assert personal_data_digest(make_docs([])).collect() == []
