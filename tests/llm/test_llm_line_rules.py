"""Line rules on fixtures, against brute force and against the SQL twin of the query."""

import random
from collections import Counter

import duckdb
import pytest
from llm_fixtures import documents, odd_rows

from claimloom.llm import line_rules as r
from claimloom.llm.oracle import LINE_RULES


def plain_repeated(words):
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    return len({i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)})


@pytest.mark.parametrize(
    "text", ["", "a", "a a a", "a a a a", "a b c a b c", "x a b c y a b c z a b", "a b a b a b a", "p q r s " * 9]
)
def test_repeated_words(text):
    words = text.encode().split()
    assert r.repeated_words(words) == plain_repeated(words)


def unique_lines(n, at, words=12):
    return [" ".join(f"d{n}l{at + k}w{i}" for i in range(words)) for k in range(6)]


def corpus():
    """Forty clean documents, boilerplate in all, three made of it only, and many copies."""
    notice = "This page is served under the usual terms by the host of all these pages here"
    menu = " ".join(f"menu item {i}" for i in range(30))
    rows = [(n, "\n".join([notice.upper(), menu, *unique_lines(n, 0, 25)]), "a") for n in range(40)]
    rows += [(100 + n, "\n".join([notice, menu, f"only these {n} words"]), "a") for n in range(3)]
    # Copies that differ in case and white space are one document.
    rows += [(200 + n, ("\n" * (n % 3) + "  ").join(unique_lines("copy", 0)).replace("l", "lL"[n % 2]), "a") for n in range(30)]
    rows += [(300, notice + "\n" + menu, "b"), (301, None, None), (301, None, None)]
    return rows


def test_common_lines_go_and_copies_do_not(spark):
    docs = documents(spark, corpus())
    got = {row.doc_id: row for row in r.line_rules(docs).collect()}
    assert all(got[n].kept and got[n].removed_words == 106 for n in range(40))
    assert not any(got[100 + n].kept or got[100 + n].base_failed for n in range(3))
    assert all(got[200 + n].kept for n in range(30))
    assert got[300].kept and got[300].removed_words == 0
    assert got[301].base_failed and not got[301].kept
    out = r.apply_line_rules(docs)
    assert out.columns == docs.columns
    texts = {row.doc_id: row.text for row in out.collect()}
    assert set(texts) == {n for n in got if got[n].kept}
    assert texts[0] == "\n".join(unique_lines(0, 0, 25))
    assert len(texts[205].split()) == 72 and texts[300].startswith("This page")


def test_odd_documents(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    got = r.line_rules(docs).collect()
    assert len(got) == len(rows)
    for row, text in ((row, dict((i, t) for i, t in rows)[row.doc_id]) for row in got if row.doc_id):
        counts, _, _ = r.statistics(text)
        assert {k: row[k] for k in counts} == counts
        assert counts["n_words"] == len((text or "").encode().split())
        assert counts["n_repeat_words"] == plain_repeated((text or "").encode().split())
    one = {row.doc_id: row for row in got}
    assert (one[12].n_dup_lines, one[12].n_words) == (1, 7)
    assert one[10].base_failed and one[1].kept
    assert r.line_rules(docs.limit(0)).count() == 0
    assert r.apply_line_rules(docs.limit(0)).count() == 0
    # Repeated rows of a kept document stay, columns as they were.
    assert r.apply_line_rules(docs).where("doc_id = 2").count() == 2


def prose(rng, words=12):
    return " ".join(f"w{rng.randrange(100_000)}" for _ in range(words))


def gone(spark, rows, **limits):
    """Words removed by document."""
    got = r.line_rules(documents(spark, rows), **limits).collect()
    return {row.doc_id: row.removed_words for row in got}


@pytest.mark.parametrize("template, own", [(20, 3), (8, 3), (4, 3), (100, 3)])
def test_template_lines_go_however_many(spark, template, own):
    rng = random.Random(template)
    rows, want = [], {}
    for host in range(3):
        shared = [prose(rng) for _ in range(template)]
        for n in range(60):
            rows.append((host * 1000 + n, "\n".join(shared + [prose(rng) for _ in range(own)]), f"h{host}"))
    # Brute force: distinct texts by line, there being no copies.
    holders = Counter((h, line) for _, text, h in rows for line in set(text.split("\n")))
    for n, text, h in rows:
        want[n] = sum(len(line.split()) for line in text.split("\n") if holders[h, line] > r.LINE_DOCS)
    assert set(want.values()) == {template * 12}
    assert gone(spark, rows) == want


def twin(spark, rows):
    """The SQL twin's rows and the operator's, on the same documents."""
    docs = documents(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    names = [c for c in r.line_rules(docs).columns if c not in ("host", "text_key", "removed")]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({LINE_RULES})").fetchall()
    got = [tuple(row) for row in r.line_rules(docs).select(*names).collect()]
    assert Counter(got) == Counter(want)
    return {row[0]: dict(zip(names, row)) for row in got}


def pages(rng, count, template, own_words):
    shared = [prose(rng) for _ in range(template)]
    return [(n, "\n".join([*shared, prose(rng, own_words)]), "a") for n in range(count)]


@pytest.mark.parametrize("template, own_words", [(10, 8), (200, 48), (20, 36)])
def test_pages_of_a_template(spark, template, own_words):
    got = twin(spark, pages(random.Random(template), 500 if template == 10 else 60, template, own_words))
    assert {row["removed_words"] for row in got.values()} == {12 * template}
    assert not any(row["kept"] for row in got.values() if own_words * 100 < 30 * (12 * template + own_words))


def chain(rng, count=25):
    """Each page a near copy of the next, the first and the last unlike."""
    lines = [prose(rng) for _ in range(count + 30)]
    return [(n, "\n".join([*lines[n : n + 30], "the same notice for all of these"]), "a") for n in range(count)]


def test_partitions_do_not_matter(spark):
    rows = chain(random.Random(5)) + pages(random.Random(6), 30, 4, 20)
    rows = [(n, text, host) for n, (_, text, host) in enumerate(rows)]
    want = twin(spark, rows)
    assert {want[n]["removed_words"] > 0 for n in range(25)} == {True}
    docs = documents(spark, rows)
    for partitions in (1, 8, 211):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            got = r.line_rules(docs.repartition(min(partitions, 16))).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        assert {row.doc_id: row.removed_words for row in got} == {n: w["removed_words"] for n, w in want.items()}


def test_copies_make_no_line_common_and_hide_none(spark):
    rng = random.Random(2)
    notice = prose(rng)
    page = "\n".join([notice, prose(rng, 70), prose(rng, 60)])
    rows = [(n, "\n".join([notice, prose(rng, 70)]), "a") for n in range(30)]
    rows += [(300 + n, page, "a") for n in range(400)]
    # At another host there are only the copies: nothing is common there.
    rows += [(1000 + n, page.upper() if n % 2 else page.replace(" ", "\t "), "b") for n in range(90)]
    got = {n: row["removed_words"] for n, row in twin(spark, rows).items()}
    assert {got[n] for n in got if n < 1000} == {12}
    assert {got[n] for n in got if n >= 1000} == {0}


def test_limit_does_not_grow_with_copies_or_the_source(spark):
    rng = random.Random(3)
    line = prose(rng)
    rows = [(n, "\n".join([line, prose(rng, 60)]), "a") for n in range(11)]
    rows += [(100 + n, prose(rng, 60), "a") for n in range(1500)]
    rows += [(2000, "a b " * 40, "a")] * 1500
    got = gone(spark, rows)
    assert {got[n] for n in range(11)} == {12} and {got[n] for n in got if n >= 11} == {0}
    assert set(gone(spark, rows[1:]).values()) == {0}


def test_twin_on_odd_documents(spark):
    rows = [row for row in odd_rows() if row[0] != 9]  # letters that SQL and bytes agree on
    twin(spark, rows + corpus())
