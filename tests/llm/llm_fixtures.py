"""Odd documents and plain twins that several tests share."""

from __future__ import annotations

import duckdb

TABLES = "documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
CLASHES = "id long, fp long, root long, text_key string, host string, key string, seq long, block long, epoch long"


def connect(sf_dir: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def documents(spark, rows):
    """A documents table from (doc_id, text[, source]) with clashing extra columns."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *range(3), *"xyz", *range(3))
        for r in rows
    ]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
    return spark.createDataFrame(full, schema)


def odd_rows():
    """Nulls, empties, white space, repeated rows, one very long text, letters of all kinds."""
    base = " ".join(f"word{i}" for i in range(400))
    return [
        (1, base), (2, base), (2, base), (3, base + " end"), (4, None), (5, ""), (6, " \n\t "),
        (None, base), (None, None), (7, "one"), (8, "one two"), (9, "ÀÉ ſecret İstanbul   x"),
        (10, "long " * 50_000), (11, "日本語 テキスト\x00\x1c end"), (12, "a\nb\na\n\nb c\r\nb c"),
    ]


def components(nodes, links):
    """Least reachable node by repeated relaxation."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root
