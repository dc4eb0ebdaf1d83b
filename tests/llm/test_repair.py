import hashlib
import itertools
import random
import re
import zlib

import pytest

from tallyforge.llm import repair
from tallyforge.llm.queries import QUERIES

KINDS = "suatSUATx"


def exhaustive(kinds):
    """(cost, letters) by trying every sequence of edits with up to three inserts between rows."""
    best = None

    def go(at, out, cost, letters, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if at == len(kinds) and re.fullmatch("(s?(ua)+)?", out):
            best = min(best or (cost, letters), (cost, letters))
        if inserted < 3:
            for role in "ua":
                if not out.endswith(role) and not (role == "a" and not out.endswith("u")):
                    go(at, out + role, cost + 3, letters + "I", inserted + 1)
        if at < len(kinds):
            k, more = kinds[at], 3 if kinds[at].isupper() else 0
            go(at + 1, out, cost + 4, letters + "D", 0)
            if k != "x":
                if re.fullmatch("s?(ua)*u?", out + k.lower()):
                    go(at + 1, out + k.lower(), cost + more, letters + "K", 0)
                for role in "ua":
                    if re.fullmatch("s?(ua)*u?", out + role):
                        go(at + 1, out + role, cost + 3 + more, letters + "R", 0)

    go(0, "", 0, "", 0)
    return best


def by_strings(kinds):
    """The same by whole strings per state, for longer conversations."""
    states = {"": (0, ""), "u": (3, "I"), "a": (6, "II")}
    for k in kinds:
        new, more = {}, 3 if k.isupper() else 0

        def offer(state, way):
            new[state] = min(new.get(state, way), way)

        for state, (cost, letters) in states.items():
            offer(state, (cost + 4, letters + "D"))
            if k != "x":
                to = {"": "u", "s": "u", "a": "u", "u": "a"}[state]
                offer(to, (cost + 3 + more, letters + "R"))
                if k.lower() == to or (k.lower(), state) == ("s", ""):
                    offer(k.lower(), (cost + more, letters + "K"))
        for state in ("", "s", "a"):
            if state in new:
                offer("u", (new[state][0] + 3, new[state][1] + "I"))
        if "u" in new:
            offer("a", (new["u"][0] + 3, new["u"][1] + "I"))
        states = new
    return min(states[s] for s in ("", "a") if s in states)


def searched(kinds):
    steps = repair.Steps()
    one, most = repair.Search(steps), 0
    for k in kinds:
        one.row(k)
        most = max(most, one.pending())
    letters = one.finish().decode()
    return (one.cost, letters), most


def test_every_short_conversation():
    for n in range(4):
        for kinds in itertools.product(KINDS, repeat=n):
            assert searched(kinds)[0] == by_strings(kinds) == exhaustive(kinds), kinds


def test_long_conversations_with_ties():
    rng = random.Random(1)
    for letters in ("suatSUATx", "ut", "u", "uuax", "UT", "tttu", "aS", "sx"):
        for n in (7, 60, 400):
            kinds = [rng.choice(letters) for _ in range(n)]
            assert searched(kinds)[0] == by_strings(kinds), (letters, n)


def test_memory_follows_the_unresolved_stretch():
    rng = random.Random(2)
    kinds = [k if rng.random() < 0.8 else rng.choice("xtU") for k in "ua" * 20_000]
    (cost, letters), most = searched(kinds)
    assert most < 200 and len(letters) - letters.count("I") == 40_000
    assert searched("sua" + "x" * 30_000)[1] < 50
    assert searched("u" * 3_000)[1] < 4 * 4_500  # two ways stay open to the end: a byte an edit each


def whole(rows):
    """The query's contract, row by row in Python."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        convs.setdefault(conv, []).extend([(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1))
    out = []
    for conv, those in convs.items():
        those.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, kinds = set(), [], []
        for turn, role, text in those:
            solid = re.sub(r"[\x20\x09-\x0d]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            kinds.append(repair.row_class(role[:1], fault))
        cost, letters = by_strings(kinds)
        lines, last, left = [], "", list(those)
        for e in letters:
            _, role, text = (None, None, "") if e == "I" else left.pop(0)
            if e != "D":
                if e != "K":
                    role = "assistant" if last == "u" else "user"
                last = role[:1]
                lines.append(f"{role}:{text}")
        turns = {t for t, _, _ in those if t is not None}
        initials = [r[:1] for _, r, _ in those]
        out.append(
            (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
             sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        )
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, edit string, live_ int").repartition(3)
    return sorted((tuple(r) for r in repair.digests(repair.repair(repair.damaged(df))).collect()), key=str)


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "User"]), rng.choice(["Good.", "cut", None, "", "  \t", "Ends! ", "日本。", " ", "Same?"])) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(None, None, None, None), (None, 3, "user", "x."), (50, None, "user", "a."), (50, None, "assistant", "b."), (50, 4, "user", "a."), (50, -7, "user", "a.")]
    rows += [(51, 1, "user", "a."), (51, 1, "user", "a."), (51, 1, "assistant", "b"), (51, 1, "user", "c")] + [(52, 9, "user", "w" * 100 + "."), (52, 9, "user", "w" * 100 + "?")]
    assert run(spark, rows[:-2]) == whole(rows[:-2])
    assert len(run(spark, rows)) == len(whole(rows))
    assert run(spark, []) == []


def test_all_rows_dropped(spark):
    conv = next(c for c in range(100, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(conv, 0, "user", "Hi.")]) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_one_conversation_with_most_rows_and_a_very_long_text(spark):
    rng = random.Random(4)
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", rng.choice(["Same.", f"Own {t}.", "cut"])) for t in range(6000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {c} {t}.") for c in range(100, 200) for t in range(4)]
    rows += [(8, 0, "user", "word " * 400_000 + "."), (8, 1, "assistant", "Yes.")]
    assert run(spark, rows) == whole(rows)


def test_repaired_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "Cut")], "conv_id long, turn long, role string, text string")
    got = [(r.conv_id, r.turn, r.edit, r.role, r.text, r.fault) for r in repair.repair(df).coalesce(1).collect()]
    assert [g for g in got if g[0] == 1] == [(1, 0, "K", "user", "Hi.", ""), (1, None, "I", "assistant", "", ""), (1, 1, "K", "user", "Again.", ""), (1, 2, "K", "assistant", "Yes.", "")]
    assert [g for g in got if g[0] == 2] == [(2, 0, "D", None, "Cut", "truncated")]


@pytest.mark.parametrize("at", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_reads_the_whole_table(spark, at):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{at}/conversations.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_conversation_repair"](spark, at).collect()), key=str) == whole(rows)
