"""Conversation repair: the cheapest edits that give a legal order of roles.

A conversation's role initials must read ``(s?(ua)+)?``. Each row is kept, gets another
role or is deleted, and rows without text may be inserted; iterative-deepening A* finds the
cheapest edits. A search goes depth first, edits in ASCII order, under a cost bound that
grows by one; the first path that ends rightly is the answer, so ties go to the string of
edits that is least. What is left of the bound where a (row, state) failed is remembered in
a transposition table, across bounds and start states.

At scale: rows are cut into blocks of 64 consecutive turns (hashed by conversation and
block, so a conversation with a third of all rows is searched by many tasks) and blocks into
parts of 16 rows. A part is solved for every state it may begin and end in: four states, at
most 12 pairs. A second shuffle brings the parts of a conversation together, in order and as
a stream: parts are joined from left to right, one candidate a state. All candidates of a
state have used the same rows and end in a row's edit, so none begins another, and joining
the least strings gives the least string. Whatever all candidates share is settled at once.

Texts are shuffled twice. Memory follows one part; in the first step also the row digests
of 64 turns (about 100 bytes each), in the second about six bytes a turn of the conversation
in hand, whose rows pass one task since their digest is one hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.session import on_executors

PART = 16
TURN_BITS = 6
BLANK = " \t\n\x0b\x0c\r"
USER, ASSISTANT = "user", "assistant"
#: Costs of the edits and the pairs of neighbours that are legal.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
LEGAL = {"su", "ua", "au"}
#: States: 0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after an answer.
NEXT = (2, 2, 3, 2)
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
#: Edits that end a conversation legally, by state.
CLOSING = ("", "II", "I", "")

Solved = tuple[tuple[int, int, int, str], ...]


def least_costs(code: str) -> list[int]:
    """For each suffix of a part a cost that no edits can undercut.

    Blank and repeated rows cost their deletion, truncated ones at least their surcharge.
    Two neighbours that may not meet, or a row of another role, cost one edit more; pairs
    are taken without overlap, from the end.
    """
    out, live, used = [0] * (len(code) + 1), "", True
    for i in range(len(code) - 1, -1, -1):
        c, extra = code[i], 0
        if c == "d":
            out[i] = out[i + 1] + DELETE
            continue
        cut = c.isupper()  # deleting it saves its surcharge
        if c in "xX":
            extra, used = (DELETE - TRUNCATED if cut else REROLE), True
        elif not used and (c + live).lower() not in LEGAL:
            extra, used = (DELETE - TRUNCATED if cut or live.isupper() else REROLE), True
        else:
            used = False
        live = c
        out[i] = out[i + 1] + extra + (TRUNCATED if cut else 0)
    return out


@lru_cache(maxsize=1 << 15)
def solve(code: str) -> Solved:
    """(begin, end, cost, edits) for each pair of states that a part can join.

    ``code`` has a letter a row: its role's initial (x for any other), upper case where it is
    truncated, or d where it must be deleted. Edits end with those of the last row, so
    insertions behind it belong to the next part.
    """
    n, least, out = len(code), least_costs(code), []
    if not n:
        return tuple((q, q, 0, "") for q in range(4))
    for end in range(4):
        failed: dict[tuple[int, int], int] = {}

        def search(i: int, state: int, left: int) -> str | None:
            if left < least[i]:
                return None
            if i == n:
                return "" if state == end else None  # noqa: B023
            if failed.get((i, state), -1) >= left:  # noqa: B023
                return None
            c = code[i]
            more = TRUNCATED if c.isupper() else 0
            steps = [("D", i + 1, state, DELETE), ("I", i, NEXT[state], INSERT)]
            if c != "d":
                if (kept := KEPT.get((c.lower(), state))) is not None:
                    steps.append(("K", i + 1, kept, more))
                steps.append(("R", i + 1, NEXT[state], REROLE + more))
            for edit, row, then, cost in steps:
                if (rest := search(row, then, left - cost)) is not None:
                    return edit + rest
            failed[i, state] = left  # noqa: B023
            return None

        for begin in range(4):
            # nothing returns to state 0, and only a kept system turn leads to state 1
            if begin != end and (end == 0 or (end == 1 and (begin > 0 or "s" not in code.lower()))):
                continue
            bound = least[0]
            while (found := search(0, begin, bound)) is None:
                bound += 1
            out.append((begin, end, bound, found))
    return tuple(out)


class Chain:
    """Joins the parts of one conversation, one candidate for each state."""

    def __init__(self) -> None:
        self.costs: dict[int, int] = {0: 0}
        self.rank: dict[int, int] = {0: 0}  # order of the candidates' edits
        self.open: list[dict[int, tuple[int, str]]] = []
        self.done: list[str] = []

    def add(self, solved: Solved) -> None:
        best: dict[int, tuple[int, int, str, int]] = {}
        for begin, end, cost, edits in solved:
            if begin in self.costs:
                offer = (self.costs[begin] + cost, self.rank[begin], edits, begin)
                best[end] = min(best.get(end, offer), offer)
        self.costs = {e: b[0] for e, b in best.items()}
        self.rank = {e: r for r, e in enumerate(sorted(best, key=lambda e: best[e][1:3]))}
        before = {b[3] for b in best.values()}
        if len(before) == 1:
            self._settle(before.pop())
        self.open.append({e: (b[3], b[2]) for e, b in best.items()})

    def _settle(self, state: int) -> None:
        tail = []
        for part in reversed(self.open):
            state, edits = part[state]
            tail.append(edits)
        self.done += reversed(tail)
        self.open.clear()

    def close(self) -> tuple[int, list[str], str]:
        """Cost, edits of each part, and the insertions at the end."""
        end = min(self.costs, key=lambda e: (self.costs[e] + INSERT * len(CLOSING[e]), self.rank[e]))
        self._settle(end)
        return self.costs[end] + INSERT * len(CLOSING[end]), self.done, CLOSING[end]


# --- first step: blocks of turns ---

_PARTS = "conv_id long, kind int, block long, part long, seq int, role string, text string, solved array<struct<begin:int,end:int,cost:int,edits:string>>, facts array<long>, ends array<string>"
_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("kind", pa.int32()),
        ("block", pa.int64()),
        ("part", pa.int64()),
        ("seq", pa.int32()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("solved", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int32()), ("edits", pa.string())]))),
        ("facts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.string())),
    ]
)


class _Out:
    """Rows in Arrow batches of at most so many rows or bytes of text."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.size += size + 64

    def full(self) -> bool:
        return self.size > 1 << 22

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in self.schema]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


class _Part:
    """The rows of a part as they come: its code and what is counted on it."""

    def __init__(self) -> None:
        self.code = ""
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = ""
        self.low: int | None = None
        self.high: int | None = None

    def add(self, turn: int | None, role: str, text: str, seen: bool, new_turn: bool) -> None:
        body, initial = text.rstrip(BLANK), role[:1]
        cut = body[-1:] not in (".", "!", "?")
        self.blank += not body
        self.duplicate += bool(body) and seen
        self.truncated += bool(body) and not seen and cut
        letter = initial if initial in ("s", "u", "a") else "x"
        if self.code:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.code += "d" if seen or not body else letter.upper() if cut else letter
        self.last = initial
        if turn is not None:
            self.turns += new_turn
            self.low = turn if self.low is None else self.low
            self.high = turn

    def row(self, conv: int | None, block: int | None, part: int) -> tuple:
        solved = [dict(zip(("begin", "end", "cost", "edits"), s, strict=True)) for s in solve(self.code)]
        facts = [len(self.code), self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high]
        ends = [self.first, self.last] if self.code else None
        return (conv, 0, block, part, None, None, None, solved, facts, ends)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (kind 0) for each part with what was found, and its rows (kind 1) behind."""
    out, key, own, number, seen, turn_before = _Out(_ARROW), None, _Part(), 0, set(), None
    for batch in batches:
        for conv, block, kind, turn, role, text, same in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != (conv, block):
                if key is not None:
                    out.add(own.row(*key, number))
                key, own, number, seen, turn_before = (conv, block), _Part(), 0, set(), None
            if kind == 0:  # the conversation's own mark, or a row that stands in an earlier block
                if same is not None:
                    seen.add(same)
                continue
            if len(own.code) == PART:
                out.add(own.row(*key, number))
                own, number = _Part(), number + 1
            out.add((conv, 1, block, number, len(own.code), role, text, None, None, None), len(role) + 2 * len(text))
            own.add(turn, role, text, same in seen, turn != turn_before)
            seen.add(same)
            turn_before = turn
            if out.full():
                yield out.batch()
    if key is not None:
        out.add(own.row(*key, number))
    yield out.batch()


# --- second step: whole conversations ---

_TURNS = "conv_id long, position long, edit string, role string, text string"
_TURN_ARROW = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SUMMARY = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
_SUMMARY_ARROW = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Conversation:
    """One conversation: first its parts, then its rows."""

    def __init__(self) -> None:
        self.chain, self.counts, self.turns, self.low, self.high, self.last = Chain(), [0] * 4, 0, None, None, None
        self.edits: Iterator[str] | None = None
        self.parts: list[str] = []
        self.state = self.position = 0

    def part(self, solved: list[dict], facts: list[int | None], ends: list[str] | None) -> None:
        self.chain.add(tuple((s["begin"], s["end"], s["cost"], s["edits"]) for s in solved))
        for i in range(4):
            self.counts[i] += facts[1 + i]
        self.turns += facts[5]
        if facts[6] is not None:
            self.low, self.high = (facts[6] if self.low is None else self.low), facts[7]
        if ends is not None:
            self.counts[3] += self.last is not None and self.last + ends[0] not in LEGAL
            self.last = ends[1]

    def _next(self) -> Iterator[str]:
        for part in self.parts:
            yield from part

    def settle(self) -> None:
        if self.edits is None:
            self.cost, self.parts, self.tail = self.chain.close()
            self.edits = self._next()

    def _emit(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        if edit == "K":
            self.state = KEPT[role[0], self.state]
        else:
            role, self.state = (ASSISTANT if self.state == 2 else USER), NEXT[self.state]
        return edit, role, text

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired rows up to and with this one."""
        self.settle()
        for edit in self.edits:
            if edit == "I":
                yield self._emit("I", "", "")
                continue
            if edit != "D":
                yield self._emit(edit, role, text)
            return

    def rest(self) -> Iterator[tuple[str, str, str]]:
        self.settle()
        for _ in self.tail:
            yield self._emit("I", "", "")

    def facts(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.counts, self.cost, "".join(self.parts) + self.tail)


class _Digest:
    """Emits one row for each conversation."""

    schema = _SUMMARY_ARROW

    def __init__(self) -> None:
        self.begin()

    def begin(self) -> None:
        self.hash, self.any = hashlib.sha256(), False

    def turn(self, out: _Out, conv: int | None, position: int, turn: tuple[str, str, str]) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{turn[1]}:{turn[2]}".encode())
        self.any = True

    def end(self, out: _Out, conv: int | None, own: _Conversation) -> None:
        facts = own.facts()
        out.add((conv, *facts, self.hash.hexdigest()), len(facts[-1]))


class _Turns:
    """Emits the repaired rows."""

    schema = _TURN_ARROW

    def begin(self) -> None:
        pass

    def turn(self, out: _Out, conv: int | None, position: int, turn: tuple[str, str, str]) -> None:
        out.add((conv, position, *turn), 2 * len(turn[2]))

    def end(self, out: _Out, conv: int | None, own: _Conversation) -> None:
        pass


def _conversations(make: type[_Digest] | type[_Turns], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    to, own, current = make(), None, None
    out = _Out(to.schema)

    def say(turns: Iterator[tuple[str, str, str]]) -> None:
        for turn in turns:
            to.turn(out, current, own.position, turn)
            own.position += 1

    for batch in batches:
        for conv, kind, _, _, _, role, text, solved, facts, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if own is None or conv != current:
                if own is not None:
                    say(own.rest())
                    to.end(out, current, own)
                own, current = _Conversation(), conv
                to.begin()
            if kind == 0:
                own.part(solved, facts, ends)
            else:
                say(own.row(role, text))
            if out.full():
                yield out.batch()
    if own is not None:
        say(own.rest())
        to.end(out, current, own)
    yield out.batch()


def _searched(conversations: DataFrame, every: DataFrame | None) -> DataFrame:
    """Parts and rows, those of a conversation together and in order."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    rows = rows.select("conv_id", F.shiftright("turn", TURN_BITS).alias("block"), F.lit(1).alias("kind"), "turn", "role", "text", same.alias("same"))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("text", "string"))]
    # A row of an earlier block is told to the later blocks that have it too, by its digest.
    held = rows.groupBy("conv_id", "same", "block").agg(F.count(F.lit(1)).alias("n"))
    low = F.coalesce("block", F.lit(-(1 << 62)))
    first = held.groupBy("conv_id", "same").agg(F.min(low).alias("first"), F.count(F.lit(1)).alias("blocks")).where("blocks > 1")
    later = held.alias("h").join(first.alias("f"), F.col("h.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("h.same") == F.col("f.same")))
    told = later.where(F.coalesce("h.block", F.lit(-(1 << 62))) > F.col("f.first")).select("h.conv_id", "h.block", F.lit(0).alias("kind"), *none, F.col("h.same").alias("same"))
    rows = rows.unionByName(told)
    if every is not None:
        marks = every.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        rows = rows.unionByName(marks.select("conv_id", F.lit(None).cast("long").alias("block"), F.lit(0).alias("kind"), *none, F.lit(None).cast("binary").alias("same")))
    blocks = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "turn", "role", "text")
    parts = on_executors(blocks).mapInArrow(_blocks, _PARTS)
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "block", "part", "seq")


def repair(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, edit, role, text``: the rows of the repaired conversations, from
    position 0; ``edit`` is K for a kept row, R for one with a new role, I for an inserted one.

    Rows stand in the order of (turn, role, text), null turns first. Null roles and texts
    count as one space, rows without conv_id as one conversation; repeated rows are
    duplicates, and blank and duplicate rows go. A role whose initial is not s, u or a (an
    empty one too) cannot be kept. A conversation of which nothing stays has no rows, and an
    empty table gives none. Further columns are not read.
    """
    return _searched(conversations, None).mapInArrow(partial(_conversations, _Turns), _TURNS)


def summary(conversations: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row a conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``. The counts are of the rows as given, each by its first fault;
    ``audit`` holds the initials of the edits, the digest is that of :func:`repair`'s rows as
    ``role:text`` lines. Conversations that only ``every`` has (a table with conv_id) are
    reported with zeros, no edits and the digest of an empty text.
    """
    return _searched(conversations, every).mapInArrow(partial(_conversations, _Digest), _SUMMARY)


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's.
    Nulls count as one space, but ``turn`` and ``conv_id`` themselves stay null."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    table = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"),
        space("text").alias("text"),
        (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).cast("int").alias("fault"),
    )
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    whole = table.where("fault <> 0").select("conv_id", "turn", F.when(F.col("fault") == 4, USER).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
    return whole.drop("copy")
