"""Conversation structure repair: a survivor-coalescence Viterbi search for the cheapest edits.

A conversation is right when its roles' initials read ``(s?(ua)+)?``. Each row is kept, given another role,
deleted, or followed by inserted rows of empty text; of the cheapest ways the one whose edit letters (K, R, D, I)
are ASCII-least wins. The search goes through the rows once and holds one survivor for each state of the pattern:
nothing yet, after s, after u, after a.

* Survivors end in a tree of back pointers; a node counts the paths that need it and goes when none does. Where
  only one path is left from the root, its edits are certain and are emitted, so memory follows the unresolved
  stretch (one byte per edit and path), not the conversation. Survivors that cannot win any more, because another
  state does all they can for less, are dropped, or they would keep the tree from coalescing.
* Two ways of equal cost are told apart by their whole unresolved letters. How two survivors' letters compare
  (less, greater, or one a prefix of the other, and by which rest) is kept beside them and carried on by each new
  letter, which gives the same answer as reading both suffixes again. It is enough, as letters fix the roles: of
  two ways of the same state, cost and number of rows neither is a prefix of the other.

In Spark: repeated rows are found by a count per (conversation, role and text) with map-side partials and a join
of the repeated ones only. Rows then go by conversation, sorted by turn, and stream through one task per
partition: first their one-letter classes, without texts, which decide the edits; then the texts, to which the
edits are applied as they pass. No conversation is held, neither its texts nor its rows; what grows with it is
one byte an edit. The digest of a whole conversation is one sequential hash, so a conversation ends in one task,
however long it is; it folds the repaired rows in the stage that makes them.

Defined cases: rows of one turn follow each other by role, then by text (first ``HEAD`` characters, then md5).
Null turns come first; rows without conversation id are one conversation. Null roles and texts are one blank. A
role whose initial is not s, u or a cannot be kept. Equal rows are duplicates but for the first. Conversations
without rows come back as one row without an edit; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import workers_import_here

#: Costs of the edits, and what a truncated row costs that stays.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Characters that end a whole sentence, and those that are space.
STOPS, BLANKS = ".!?", " \t\n\x0b\x0c\r"
#: Characters of a text that order rows of one turn and role.
HEAD = 64
FAULTS = ("", "blank", "duplicate", "truncated")
_START, _S, _U, _A = range(4)
_KEEPS = {("s", _START): _S, ("u", _START): _U, ("u", _S): _U, ("u", _A): _U, ("a", _U): _A}
_STEPS = {_START: _U, _S: _U, _A: _U, _U: _A}
_ROWS = "conv_id long, turn long, edit string, was string, role string, text string, fault string"


# ------------------------------------------------------------- faults ---
def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, live and what the search needs: blank, cut, key, and when the text came first."""
    clean = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "live")
    ended = F.rtrim("text", F.lit(BLANKS))
    seen = clean.select(
        "*",
        (ended == "").alias("blank"),
        (~F.right(ended, F.lit(1)).isin(*STOPS)).alias("cut"),
        F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("key"),
    )
    live = seen.where("live").groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k"))
    first = live.agg(F.count("*").alias("n"), F.min("turn").alias("since"), F.bool_or(F.col("turn").isNull()).alias("at_null")).where("n > 1")
    met = seen.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    later = F.when(F.col("at_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("since"))
    return met.select(*seen.columns, F.coalesce(later, F.lit(False)).alias("later"))


def row_class(initial: str, fault: str) -> str:
    """A row as the search sees it: x must go, other letters are its initial, in capitals when truncated."""
    if fault in ("blank", "duplicate"):
        return "x"
    known = initial if initial in ("s", "u", "a") else "t"
    return known.upper() if fault == "truncated" else known


# ------------------------------------------------------------- search ---
def _before(one: tuple, other: tuple, order: dict) -> str:
    """How two ways (survivor, new letters) compare: '<', '>', or 'p' / 'q' and the rest by which one goes on."""
    (i, a), (j, b) = one, other
    if i != j:
        known = order[i, j]
        if known in "<>":
            return known
        a, b = (a, known[1:] + b) if known[0] == "p" else (known[1:] + a, b)
    if b.startswith(a):
        return "p" + b[len(a) :]
    if a.startswith(b):
        return "q" + a[len(b) :]
    return "<" if a < b else ">"


def _turned(order: str) -> str:
    return {"<": ">", ">": "<", "p": "q", "q": "p"}[order[0]] + order[1:]


class Steps:
    """What a row does to the survivors, by their relative costs and orders; each case is worked out once."""

    def __init__(self):
        self.known: dict = {}

    def start(self) -> tuple:
        ways = {_START: (0, 0, ""), _U: (INSERT, 0, "I"), _A: (2 * INSERT, 0, "II")}
        return self._finish(ways, {})

    def row(self, shape: tuple, kind: str) -> tuple:
        """(new shape, cost, moves) after a row of the class ``kind``."""
        found = self.known.get((shape, kind))
        if found is None:
            found = self.known[shape, kind] = self._work(shape, kind)
        return found

    def _work(self, shape: tuple, kind: str) -> tuple:
        costs, order = dict(shape[0]), dict(shape[1])
        more = CUT if kind.isupper() else 0
        ways: dict = {}

        def offer(state: int, cost: int, base: int, letters: str) -> None:
            held = ways.get(state)
            if held is None or cost < held[0] or cost == held[0] and _before((base, letters), held[1:], order)[0] in "<p":
                ways[state] = (cost, base, letters)

        for state, cost in costs.items():
            offer(state, cost + DELETE, state, "D")
            if kind != "x":
                kept = _KEEPS.get((kind.lower(), state))
                if kept is not None:
                    offer(kept, cost + more, state, "K")
                offer(_STEPS[state], cost + REROLE + more, state, "R")
        for state in (_START, _S, _A, _U):
            if state in ways:
                cost, base, letters = ways[state]
                offer(_STEPS[state], cost + INSERT, base, letters + "I")
        return self._finish(ways, order)

    def _finish(self, ways: dict, order: dict) -> tuple:
        """Drop what cannot win, take the least cost out, and say whose child each way becomes."""
        best = ways[_A][0]
        if _S in ways and ways[_S][0] > best:
            del ways[_S]
        if _START in ways and ways[_START][0] > best + DELETE:
            del ways[_START]
        least = min(w[0] for w in ways.values())
        names = sorted(ways)
        new = {(i, j): _before(ways[i][1:], ways[j][1:], order) for i in names for j in names if i != j}
        moves: list[tuple[int, bool, int, str]] = []
        for state in sorted(ways, key=lambda s: len(ways[s][2])):
            _, base, letters = ways[state]
            over = [m for m in moves if ways[m[0]][1] == base and letters.startswith(ways[m[0]][2])]
            if over:
                at = over[-1][0]
                moves.append((state, True, at, letters[len(ways[at][2]) :]))
            else:
                moves.append((state, False, base, letters))
        shape = (tuple((s, ways[s][0] - least) for s in names), tuple(sorted(new.items())))
        return shape, least, moves


class Node:
    """Edits from the node above to here; ``kids`` and ``held`` (a survivor ends here) are its references."""

    __slots__ = ("held", "kids", "letters", "up")

    def __init__(self, up, letters):
        self.up, self.letters, self.kids, self.held = up, bytearray(letters), [], False


class Search:
    """The survivors of one conversation; ``certain`` receives edits as soon as all survivors share them."""

    def __init__(self, steps: Steps):
        self.steps, self.cost, self.certain = steps, 0, bytearray()
        self.root = Node(None, b"")
        self.shape, least, moves = steps.start()
        self.ends = self._grow({_START: self.root}, moves)

    def _grow(self, old: dict, moves: list) -> dict:
        ends: dict = {}
        for state, inner, at, letters in moves:
            above = ends[at] if inner else old[at]
            node = Node(above, letters.encode())
            above.kids.append(node)
            node.held = True
            ends[state] = node
        return ends

    def row(self, kind: str) -> None:
        self.shape, cost, moves = self.steps.row(self.shape, kind)
        self.cost += cost
        old, self.ends = self.ends, self._grow(self.ends, moves)
        for node in old.values():
            node.held = False
        for node in reversed(old.values()):  # those below others first
            self._release(node)
        self._emit()

    def _release(self, node: Node) -> None:
        while node.up is not None and not node.held:
            above = node.up
            if node.kids:
                if len(node.kids) == 1:
                    self._merge(node)
                return
            above.kids.remove(node)
            node.up = None
            node = above

    def _merge(self, node: Node) -> None:
        """A node that one path needs takes over its only child."""
        child = node.kids[0]
        node.letters += child.letters
        node.kids, node.held, child.up = child.kids, child.held, None
        for kid in node.kids:
            kid.up = node
        if node.held:
            state = next(s for s, n in self.ends.items() if n is child)
            self.ends[state] = node

    def _emit(self) -> None:
        while len(self.root.kids) == 1 and not self.root.held:
            self.root = self.root.kids[0]
            self.root.up = None
            self.certain += self.root.letters
            self.root.letters = bytearray()

    def pending(self) -> int:
        """Edits in the tree, over all paths."""
        stack, n = [self.root], 0
        while stack:
            node = stack.pop()
            n += len(node.letters)
            stack += node.kids
        return n

    def finish(self) -> bytearray:
        """All edits of the cheapest right conversation; its cost is in ``cost``."""
        costs, order = dict(self.shape[0]), dict(self.shape[1])
        state = _A
        if _START in costs and (costs[_START] < costs[_A] or costs[_START] == costs[_A] and order[_START, _A] == "<"):
            state = _START
        self.cost += costs[state]
        node, rest = self.ends[state], []
        while node is not self.root:
            rest.append(node.letters)
            node = node.up
        for letters in reversed(rest):
            self.certain += letters
        return self.certain


# ------------------------------------------------------------- streaming ---
def _applied(edits: bytearray, at: int, last: str) -> tuple[list[str], int]:
    """Roles of the rows to be inserted at ``at``, and where the next row's edit is."""
    roles = []
    while at < len(edits) and edits[at] == 73:
        last = "a" if last == "u" else "u"
        roles.append("assistant" if last == "a" else "user")
        at += 1
    return roles, at


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of conversations, first without texts and then with them, to repaired rows."""
    steps = Steps()
    started = False
    conv = search = before = None
    edits, at, last, phase = bytearray(), 0, "", 0
    out: list[tuple] = []

    def tail() -> None:
        """The inserts after the last row."""
        nonlocal at
        roles, at = _applied(edits, at, last)
        out.extend((conv, None, "I", None, r, "", "") for r in roles)

    def pack() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 5]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "edit", "was", "role", "text", "fault"])

    for batch in batches:
        held = 0
        for name, part, turn, role, head, key, blank, cut, later, text in zip(*[c.to_pylist() for c in batch.columns]):
            if not started or name != conv:
                if started:
                    tail()
                started, conv, phase = True, name, -1
                edits, at, last = bytearray(), 0, ""
            if part == 2:
                if phase == -1:
                    out.append((conv, None, "", None, None, None, ""))
                continue
            if part != phase:
                phase, before = part, None
                if part == 0:
                    search = Search(steps)
                else:
                    edits = search.finish()
                    search = None
            this = (turn, role, key)
            fault = "blank" if blank else "duplicate" if later or this == before else "truncated" if cut else ""
            before = this
            if part == 0:
                search.row(row_class(role[:1], fault))
                continue
            roles, at = _applied(edits, at, last)
            for r in roles:
                out.append((conv, None, "I", None, r, "", ""))
                last = r[0]
            edit = chr(edits[at])
            at += 1
            if edit == "R":
                given = "assistant" if last == "u" else "user"
                last = given[0]
            elif edit == "K":
                given = role
                last = role[:1]
            else:
                given = None
            out.append((conv, turn, edit, role, given, text, fault))
            held += len(text)
            if held > 1_000_000 or len(out) > 20_000:
                yield pack()
                out.clear()
                held = 0
        if out:
            yield pack()
            out.clear()
    if started:
        tail()
    if out:
        yield pack()


def repair(rows: DataFrame) -> DataFrame:
    """Repaired rows in order: conv_id, turn, edit, was (role before), role, text, fault.

    ``rows`` has conv_id, turn, role, text, and may have ``live`` (false: only names its conversation). Deleted rows
    stay in with a null role, inserted ones have no turn, and a conversation without rows has one row with an empty
    edit. Rows of one conversation are neighbours in one partition, in order.
    """
    workers_import_here(rows.sparkSession)
    if "live" not in rows.columns:
        rows = rows.withColumn("live", F.lit(True))
    ready = with_faults(rows)
    phase = F.explode(F.when(F.col("live"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(2))))
    split = ready.select("conv_id", phase.alias("phase"), "turn", "role", F.substring("text", 1, HEAD).alias("head"), "key", "blank", "cut", "later", "text")
    split = split.withColumn("text", F.when(F.col("phase") == 1, F.col("text")))
    dealt = split.repartition("conv_id").sortWithinPartitions("conv_id", "phase", F.col("turn").asc_nulls_first(), "role", "head", "key")
    return dealt.mapInArrow(_repaired, _ROWS)


_DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows that follow each other, to one row of digests a conversation."""
    started, conv, state, out = False, None, None, []

    def fresh() -> dict:
        return {"turns": 0, "low": None, "high": None, "blank": 0, "duplicate": 0, "truncated": 0, "": 0, "illegal": 0, "cost": 0, "last": None, "lines": 0, "audit": bytearray(), "hash": hashlib.sha256()}

    def close() -> None:
        s = state
        gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
        out.append((conv, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"], s["audit"].decode(), s["hash"].hexdigest()))

    def pack() -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [f.split()[0] for f in _DIGEST.split(", ")])

    for batch in batches:
        for name, turn, edit, was, role, text, fault in zip(*[c.to_pylist() for c in batch.columns]):
            if not started or name != conv:
                if started:
                    close()
                started, conv, state = True, name, fresh()
            if not edit:
                continue
            s = state
            s["audit"] += edit.encode()
            if edit != "I":
                s[fault] += 1
                if turn is not None and turn != s["high"]:
                    s["turns"] += 1
                    s["low"], s["high"] = (turn if s["low"] is None else s["low"]), turn
                if s["last"] is not None and s["last"] + was[:1] not in ("su", "ua", "au"):
                    s["illegal"] += 1
                s["last"] = was[:1]
            s["cost"] += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (CUT if fault == "truncated" and edit != "D" else 0)
            if edit != "D":
                s["hash"].update(f"{chr(10) if s['lines'] else ''}{role}:{text}".encode())
                s["lines"] += 1
        if len(out) > 5_000:
            yield pack()
            out.clear()
    if started:
        close()
    if out:
        yield pack()


def digests(repaired: DataFrame) -> DataFrame:
    """One row a conversation, folded where ``repair`` leaves the rows: no shuffle."""
    return repaired.mapInArrow(_folded, _DIGEST)


# ------------------------------------------------------------- damage ---
def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults that follow from conversation id and turn; dropped ones stay as not live."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text: Column = F.when(draw == 1, "").when(draw == 2, F.translate(text_of("text"), STOPS, "")).when(draw == 0, "").otherwise(text_of("text"))
    role = F.when(draw == 4, "user").otherwise(text_of("role"))
    copies = F.explode(F.when(draw == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (draw != 0).alias("live"), copies.alias("copy")).drop("copy")
