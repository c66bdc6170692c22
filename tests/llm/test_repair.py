"""Conversation repair against a plain search over whole conversations, and its SQL."""

import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest

from labelworks.llm import repair
from labelworks.llm.queries import SQL
from tests.llm.helpers import sha


def first_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain(rows):
    """All of a conversation's columns, for its rows (turn, role, text) in any order."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    wrong = first_faults(rows)

    @lru_cache(None)
    def best(i, begun, inserted=0):
        """(cost, edits) from row i on, behind initials that may go on as ``begun`` may;
        three insertions in a row are more than any gap needs."""
        options = [(0, "")] if i == len(rows) and re.fullmatch("(s?(ua)+)?", begun) else []

        def add(cost, edit, *rest):
            after = best(*rest)
            options.append((cost + after[0], edit + after[1]))

        live = i < len(rows) and wrong[i] not in ("blank", "duplicate")
        more = 3 if live and wrong[i] else 0
        if i < len(rows):
            add(4, "D", i + 1, begun)
        for c in "sua":
            if re.fullmatch("(s|s?(ua)*u?)", begun + c):
                then = (begun + c)[-1:] if c in "su" else "ua"
                if live and c == rows[i][1][:1]:
                    add(more, "K", i + 1, then)
                if live and c != "s":
                    add(3 + more, "R", i + 1, then)
                if c != "s" and inserted < 3:
                    add(3, "I", i, then, inserted + 1)
        return min(options) if options else (10**9, "")

    cost, audit = best(0, "")
    out, i = [], 0
    for e in audit:
        done = "".join(r[:1] for r, _ in out)
        needed = "assistant" if done.endswith("u") else "user"
        if e == "I":
            out.append((needed, ""))
            continue
        if e != "D":
            out.append((rows[i][1] if e == "K" else needed, rows[i][2]))
        i += 1
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [wrong.count(w) for w in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out))), out


ROLES = ["user", "user", "user", "assistant", "assistant", "assistant", "system", "tool", "", None, "u", "User"]
SAID = ["Yes.", "No!", "Why?", "cut off", "open ", "ok. \n", "", " \t", None, "é　", "done.　"]


def made(seed=13, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8, 17, 40])):
            text = rng.choice(SAID) if rng.random() < 0.5 else f"{rng.random()}{rng.choice(['.', '', '?'])}"
            role = rng.choice(ROLES) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, rng.choice([turn, turn, turn + 1, turn * 3, None if rng.random() < 0.2 else turn]), role, text))
    for turn in range(300):  # over blocks of 64 turns; texts come back in later blocks
        rows.append((500, turn - 100, rng.choice(["user", "assistant", "assistant", "system"]), f"{rng.randrange(150)}{rng.choice(['.', '.', ''])}"))
    rows += [(600, None, "user", "Same.")] * 40 + [(None, 3, "user", "Hi."), (None, None, "assistant", "Ho."), (601, 5, None, None)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, block int, same string"


def test_repair_is_the_cheapest(spark):
    rows = made()
    table = spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA).repartition(5)
    got = {r[0]: tuple(r[1:]) for r in repair.summary(table).collect()}
    turns = {}
    for r in sorted(repair.repair(table).collect(), key=lambda r: r.position):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        want, out = plain([r[1:] for r in rows if r[0] == conv])
        assert got[conv] == want, conv
        assert turns.get(conv, []) == out
    assert repair.summary(table.limit(0)).count() == 0 and repair.repair(table.limit(0)).count() == 0


@pytest.mark.parametrize("part", [1, 3, 64])
def test_parts_do_not_matter(part):
    """Parts of any size join to one search over the whole."""
    rng = random.Random(part)
    for _ in range(150):
        code = "".join(rng.choices("suaxSUAd", k=rng.randrange(0, 12)))
        whole = repair.Chain()
        whole.add(repair.solve(code))
        chain = repair.Chain()
        for i in range(0, len(code), part):
            chain.add(repair.solve(code[i : i + part]))
        a, b = whole.close(), chain.close()
        assert (a[0], "".join(a[1]) + a[2]) == (b[0], "".join(b[1]) + b[2])


def test_no_edits_undercut_the_bound():
    rng = random.Random(3)
    for _ in range(300):
        code = "".join(rng.choices("suaxSUAXd", k=rng.randrange(1, 8)))
        assert all(cost >= repair.least_costs(code)[0] for _, _, cost, _ in repair.solve(code))


def test_damage_and_sql(spark):
    rows = [r for r in made(7) if r[0] is not None] + [(700, t, "user", "Gone.") for t in range(3000) if zlib.crc32(f"700:{t}".encode()) % 20 == 0][:3]
    table = spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA)
    damaged = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        damaged += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    got = sorted(map(tuple, repair.summary(repair.damage(table), table).collect()))
    assert got == sorted((c, *plain([r[1:] for r in damaged if r[0] == c])[0]) for c in {r[0] for r in rows})
    assert next(r for r in got if r[0] == 700) == (700, 0, 0, 0, 0, 0, 0, "", sha(""))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert got == sorted(con.execute(SQL["op13_conversation_repair"]).fetchall())
