"""Secret scans against plain regular expressions and against their SQL."""

import random
import re
import zlib

import duckdb

from labelworks.llm import leaks
from labelworks.llm.queries import SQL
from tests.llm.helpers import sha

DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def with_check(prefix, body):
    crc, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        crc, d = divmod(crc, 62)
        digits = DIGITS[d] + digits
    return prefix + body + digits


def plain_spans(text):
    found = []
    for place, (kind, pattern, good) in enumerate(
        [
            ("assign", ASSIGN, lambda m: len(m[2]) >= 8),
            ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
            ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
            ("github", re.compile("(gh[pousr]_)([0-9A-Za-z]+)"), lambda m: len(m[2]) == 36 and with_check(m[1], m[2][:30]) == m[0]),
            ("npm", re.compile("(npm_)([0-9A-Za-z]+)"), lambda m: len(m[2]) == 36 and with_check(m[1], m[2][:30]) == m[0]),
        ]
    ):
        found += [(m.start(), place, kind, m.end()) for m in pattern.finditer(text or "") if good(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


BODY = "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7cF0"
TOKEN = with_check("ghp_", BODY)
PIECES = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "ſecret", "toKen", ":", "=", " = ", '"', "'", "  ", "\n", "é", "\U0001f511", "hunter2xyz", "abc", "A-b/c+d.e=f_g", "AKIA", "akia", "ABCDEFGH12345", "0" * 16, "deadbeef" * 4, "f" * 31, "g", TOKEN, TOKEN[:-1] + "!", with_check("npm_", BODY[::-1]), "ghs_", "x"]
TEXTS = [
    None, "", " ", "password", "password=short", 'x "token" : "ab12cd34"', "token = '0123456789abcdef0123456789abcdef'", "password==abcdefg=", "api_key:apikey=12345678", "secret=secret=12345678",
    "AKIA" + "A" * 11, "AKIA" + "A" * 12, "xAKIAAKIAAKIAAKIA0", "a" * 31, "a" * 32, "A" * 40, "é" * 9 + "a" * 33 + "G", TOKEN, TOKEN + "0", f"é {TOKEN},{TOKEN} npm_{TOKEN[4:]}", TOKEN.replace("ghp", "ghq"),
    "token" + " " * 50000 + "=" + "z" * 8, "password=" + "Ab1" * 200000, "f" * 100003, "word " * 100000 + "passwd:'12345678'",
]


def fixture():
    rng = random.Random(11)
    texts = TEXTS + ["".join(rng.choices(PIECES, k=rng.randrange(1, 14))) for _ in range(600)]
    return list(enumerate(texts)) + [(3, TEXTS[5]), (3, TEXTS[5]), (None, "token=abcdefgh")]


def test_spans_are_those_of_plain_expressions(spark):
    rows = fixture()
    table = spark.createDataFrame([(*r, "own", 5) for r in rows], "doc_id long, text string, spans string, kind int").repartition(3)
    got = sorted((r.doc_id, [tuple(s) for s in r.spans]) for r in leaks.find(table.where("doc_id is not null")).collect())
    assert got == sorted((d, plain_spans(t)) for d, t in rows if d is not None)
    assert {s[0] for _, spans in got for s in spans} == set(leaks.ORDER)
    assert [r.doc_id for r in leaks.find(table.where("doc_id is null")).collect()] == [None]
    assert leaks.find(table.limit(0)).count() == 0


def test_digest_matches_sql(spark):
    rows = [r for r in fixture()[: 25 + 600] if not any(c in (r[1] or "") for c in "\0")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted(map(tuple, leaks.secret_digest(table).collect()))
    con = duckdb.connect()
    con.register("documents", table.toPandas())
    want = sorted(con.execute(SQL["op11_secret_scan"]).fetchall())
    assert got == want and any("github" in r[5] for r in got) and any("npm" in r[5] for r in got)
    base = [s for s in plain_spans(TEXTS[6]) if s[0] in leaks.BASE]
    assert next(r for r in got if r[0] == 6)[1:5] == (1, 0, 1, sha(",".join(f"{k}:{a}:{b}" for k, a, b in base)))
