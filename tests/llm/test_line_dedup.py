import time
from collections import defaultdict

from llm_cases import ODD
from pyspark.sql import functions as F
from quarry.llm.line_dedup import _lines, boilerplate_lines, line_dedup_digest, remove_boilerplate


def strip(x):
    return x.strip(" \t\r")


def plain(rows, least):
    """Texts left, by position in ``rows``; rows must differ in (doc_id, text)."""
    sites, places = defaultdict(set), defaultdict(list)
    for at, (i, t, s) in enumerate(rows):
        for n, x in enumerate((t or "").split("\n")):
            if strip(x):
                sites[strip(x)].add(s)
                places[strip(x)].append((i, n, at))
    gone = {(at, n) for x, p in places.items() if len(sites[x]) >= least for i, n, at in sorted(p)[1:]}
    return [None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (at, n) not in gone)
            for at, (i, t, s) in enumerate(rows)]


def test_against_plain_python(make_docs):
    rows = [(i, f"head\nown {i}\n\n  foot \nrare {i % 7}\nhead", f"s{i % 6}") for i in range(40)]
    rows += [(100 + i, f"four\nline {i}", f"s{i % 4}") for i in range(12)] + [(200, "four", None)]
    rows += [(300, None, "s0"), (301, "", "s0"), (302, "head", "s0"), (303, "head\r\n \t\nfoot", "s1")]
    out = remove_boilerplate(make_docs(rows, extra=["line", "site"]), 5)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "line", "site", "n_lines", "n_removed"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for (i, t, _), want in zip(rows, plain(rows, 5), strict=True):
        assert got[i].text == want
        assert got[i].n_lines == (len(t.split("\n")) if t is not None else 0)
        assert got[i].n_removed == (len(t.split("\n")) - len(want.split("\n")) if t and want else
                                    (len(t.split("\n")) if t else 0))


def test_sketch_decides_far_and_counts_decide_near(make_docs):
    rows = [(k * 1000 + i, f"line {k}", f"site {i}") for k in (5, 17, 20, 22, 60) for i in range(k)]
    lines = _lines(make_docs(rows))
    names = {r.line: r for r in lines.groupBy("line").count().collect()}
    kept = {names[r.line]["count"] for r in boilerplate_lines(lines, 20).collect()}
    assert kept == {20, 22, 60}


def test_one_copy_of_a_widely_copied_text_stays(make_docs):
    rows = [(i, "one\ntwo\nthree", f"s{i}") for i in range(8)]
    left = {r.doc_id: r.text for r in remove_boilerplate(make_docs(rows), 5).collect()}
    assert left[0] == "one\ntwo\nthree" and set(left.values()) == {"one\ntwo\nthree", ""}


def test_odd_rows_and_repeats(make_docs):
    got = line_dedup_digest(make_docs(ODD + ODD), 5).collect()
    assert len(got) == 2 * len(ODD)
    assert all(r.n_removed == 0 for r in got)


def test_empty(make_docs):
    assert line_dedup_digest(make_docs([])).collect() == []


def test_clashing_names_and_no_source(make_docs):
    """Columns called like those the operator works with come through."""
    names = ["gone", "text_hash", "text_crc", "_hash", "_crc", "_id", "_row", "_doc", "_lines", "place", "a", "b"]
    rows = [(i, "one\ntwo", f"s{i}") for i in range(6)]
    docs = make_docs(rows, extra=[*names, "n_lines", "n_removed"])
    plain_out = remove_boilerplate(docs, 5, counts=False)
    assert plain_out.columns == docs.columns
    assert all(r[c] == "x" for r in plain_out.collect() for c in (*names, "n_lines", "n_removed"))
    counted = remove_boilerplate(docs, 5)
    assert sorted(counted.columns) == sorted(docs.columns) and {r.n_lines for r in counted.collect()} == {2}
    bare = make_docs(rows).drop("source")
    assert sorted(r.text for r in remove_boilerplate(bare, 1).collect()) == [""] * 5 + ["one\ntwo"]


def test_many_shared_lines(make_docs):
    text = "\n".join(f"line {i}" for i in range(40_000))
    rows = [(i, text if i % 2 else text + "\nown\n", f"s{i}") for i in range(6)]
    got = {r.doc_id: r for r in remove_boilerplate(make_docs(rows), 5).collect()}
    assert got[0].n_removed == 0 and got[1].text == "" and got[2].text == "own\n"


def test_cutting_lines_takes_linear_time(ckpt):
    """Every second line goes; four times the lines take about four times as
    long (a search of the numbers per line took sixteen)."""
    from quarry.llm.line_dedup import without_lines

    def seconds(n):
        df = ckpt.range(4).select(F.split(F.array_join(F.sequence(F.lit(1), F.lit(n)), "\n"), "\n").alias("lines"),
                                  F.sequence(F.lit(0), F.lit(n - 1), F.lit(2)).alias("gone")).repartition(4).persist()
        df.count()
        start = time.time()
        left = df.select(F.octet_length(without_lines(F.col("lines"), F.col("gone")))).collect()
        df.unpersist()
        assert left[0][0] == sum(len(str(i)) + 1 for i in range(2, n + 1, 2)) - 1
        return time.time() - start

    seconds(1000)
    small, large = seconds(100_000), seconds(400_000)
    assert large < 10 * max(small, 0.3)
