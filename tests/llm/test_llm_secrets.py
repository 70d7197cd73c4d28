"""Secret spans against one plain pattern per kind over the whole text."""

import base64
import random
import re
import zlib

import pytest
from llm_fixtures import documents, odd_rows

from claimloom.llm import secret_scan as s

def either(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


NAMES = [*map(either, ("password", "passwd", "secret", "token")), f"{either('api')}_?{either('key')}"]
PLAIN = {
    "assign": re.compile(
        f"({'|'.join(NAMES)})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
SF = "/root/testdata/sf0.01"
LEAST = {"assign": 6, "access": 20, "hex": 24}


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], s.KINDS.index(x[0])))


def forge_token(body):
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, d = divmod(value, 62)
        digits = s.BASE62[d] + digits
    return f"ghp_{body}{digits.rjust(6, '0')}"


def test_random_texts_equal_plain_patterns():
    rng = random.Random(5)
    parts = [
        "password", "PassWord", "passwd", "secret", "ſecret", "toKen", "toKen", "api_key", "apikey", "AKIA",
        "AKIAAKIA", "0123456789abcdef", "deadbeef" * 3, "=", ": ", "  ", "'", '"', "abcdef", "ABC123", "é", "日本",
        "İ", "\n", "tokentoken", "abc", "-_.=+/", "A" * 16,
    ]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(12)))
        assert [x for x in s.secret_spans(text) if x[0] in s.BASE] == plain_base(text), text


def test_checksums_decide():
    good = forge_token("a1B2" * 7 + "xy")
    assert s.joined(s.secret_spans(f"é {good}.")) == "forge:2:42"
    assert not s.secret_spans(good[:-1] + ("0" if good[-1] != "0" else "1"))
    assert s.secret_spans("npm_" + good[4:])[0][0] == "registry"
    # A published example account number.
    assert s.joined(s.secret_spans("IBAN: GB82 WEST 1234 5698 7654 32")) == "iban:0:33"
    assert not s.secret_spans("IBAN: GB83 WEST 1234 5698 7654 32")


@pytest.mark.parametrize(
    "number",
    [
        "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32", "gb82 west 1234 5698 7654 32",
        "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606",
        "MT84 MALT 0110 0001 2345 MTLC AST0 01S",
    ],
)
def test_account_numbers_in_prose(number):
    after = ["", " please pay now", " is my account", " 12 a B c d e f g h", " by iban", ", thanks", "\n2 x", "  z"]
    for rest in after:
        text = f"é IBAN: {number}{rest}"
        assert s.joined(s.secret_spans(text)) == f"iban:2:{8 + len(number)}", text
        assert s.masked(text, s.secret_spans(text)) == f"é [iban]{rest}"
    # Of two, a wrong one does not take the place of the next.
    assert [k for k, *_ in s.secret_spans(f"iban GB83WEST12345698765432 or iban {number} now")] == ["iban"]
    assert not s.secret_spans("IBAN GB83 WEST 1234 5698 7654 32 is wrong")


def test_account_number_of_an_unlisted_country():
    body = "1234567890123456"
    check = next(n for n in range(2, 99) if s.mod97_holds(f"ZZ{n:02}{body}"))
    number = f"ZZ{check:02}{body}"
    assert s.joined(s.secret_spans(f"iban {number} is mine")) == f"iban:0:{5 + len(number)}"


@pytest.mark.parametrize("text", [None, "", " "])
def test_nothing_to_find(text):
    assert s.secret_spans(text) == [] and s.masked(text, []) == text


def test_masking_leaves_no_secret():
    key = base64.b16encode(b"0123456789abcdef").decode().lower()
    text = f"é token = {key} and AKIA{'A1' * 9} stays"
    spans = s.secret_spans(text)
    assert {k for k, _, _ in spans} == {"assign", "access", "hex"}
    assert s.masked(text, spans) == "é [assign] and [access] stays"


def test_operator_on_odd_rows(spark):
    rows = [*odd_rows(), (20, "passwd: 'hunter22' é"), (21, "x " * 60_000 + "token=abcdefgh")]
    docs = documents(spark, rows)
    got = sorted(map(tuple, s.scan_secrets(docs).select("doc_id", "n_assign", "spans").collect()), key=str)
    want = [(i, sum(k == "assign" for k, _, _ in plain_base(t)), s.joined(s.secret_spans(t))) for i, t in rows]
    assert got == sorted(want, key=str)
    masked = s.with_length(s.mask_secrets(docs))
    assert masked.columns == docs.columns and masked.count() == len(rows)
    by_id = {r.doc_id: r for r in masked.where("doc_id >= 20").collect()}
    assert by_id[20].text == "[assign]' é" and by_id[20].n_chars == len("[assign]' é")
    assert s.scan_secrets(docs.limit(0)).count() == 0


def test_registered_query_equals_plain_patterns(spark):
    from claimloom.llm.queries import op5_secret_scan

    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = op5_secret_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_base(texts[row.doc_id])
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(
            sum(k == kind for k, _, _ in base) for kind in s.BASE
        )
    assert any(r.n_assign for r in rows)
