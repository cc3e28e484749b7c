"""Conversation repair against trying every edit sequence and against a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from chargepulse.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, at int, kind int, edit string, part int"


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain(rows):
    """(cost, audit, repaired rows): for each end state the least (cost, audit) and what it leaves, row by row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        out = dict(best)
        for _ in range(3):
            for state, (cost, audit, kept) in list(out.items()):
                for x in "ua":
                    to = step.get((state, x))
                    if to:
                        new = (cost + 3, audit + "I", (*kept, (names[x], "")))
                        if to not in out or new[:2] < out[to][:2]:
                            out[to] = new
        return out
    best = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults(rows)):
        after = {}
        for state, (cost, audit, kept) in inserted(best).items():
            ways = [(4, "D", state, ())]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if (state, role[:1]) in step:
                    ways.append((extra, "K", step[state, role[:1]], ((role, text),)))
                ways += [(3 + extra, "R", step[state, x], ((names[x], text),)) for x in "ua" if (state, x) in step]
            for c, letter, to, more in ways:
                new = (cost + c, audit + letter, (*kept, *more))
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        best = after
    done = inserted(best)
    return min((done[s] for s in ("", "a") if s in done), key=lambda x: x[:2])


def every(rows):
    """The least (cost, audit) of all edit sequences with at most two inserts at a place."""
    marks, best = faults(rows), None
    options = []
    for (role, _), fault in zip(rows, marks):
        own = [("D", 4, "")]
        if fault not in ("blank", "duplicate"):
            extra = 3 * (fault == "truncated")
            own += [("K", extra, role[:1]), ("R", 3 + extra, "u"), ("R", 3 + extra, "a")]
        options.append(own)
    gaps = ["", "u", "a", "ua", "au"]
    for edit in itertools.product(*options):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            final = "".join(i + e[2] for i, e in zip(ins, (*edit, ("", 0, ""))))
            if legal(final):
                cost = sum(e[1] for e in edit) + 3 * sum(map(len, ins))
                audit = "".join("I" * len(i) + e[0] for i, e in zip(ins, (*edit, ("", 0, ""))))
                best = min(best or (cost, audit), (cost, audit))
    return best


def some(rng, n):
    return [(rng.choice(["system", "user", "assistant", "tool", "user", "assistant"]), rng.choice(["a.", "b!", "c", "", " ", "d?", f"x{rng.random()}."]))
            for _ in range(n)]


def kinds(rows):
    code = {"s": 0, "u": 1, "a": 2}
    special = {"blank": R.BLANK, "duplicate": R.DUPLICATE}
    return [special.get(f, code.get(role[:1], 3) + R.CUT * (f == "truncated")) for (role, _), f in zip(rows, faults(rows))]


def solved(rows):
    out = []
    state = R.solve(kinds(rows), R.EMPTY, R.FINISH, out)
    return "".join(out) + "I" * (R.FINISH[state] // 3)


def test_the_plain_program_is_the_least_of_all_sequences():
    rng = random.Random(1)
    for _ in range(60):
        rows = some(rng, rng.randint(1, 3))
        assert plain(rows)[:2] == every(rows), rows


def test_divide_and_conquer_finds_the_least_audit():
    rng = random.Random(2)
    for _ in range(1500):
        rows = some(rng, rng.randint(1, 25))
        assert solved(rows) == plain(rows)[1], rows


def expected(conversations):
    """Rows of the query for {conv_id: rows of (turn, role, text)} that are not damaged further."""
    out = []
    for conv, rows in conversations.items():
        rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        pairs = [r[1:] for r in rows]
        marks = faults(pairs)
        cost, audit, kept = plain(pairs) if pairs else (0, "", ())
        turns = {t for t, _, _ in rows if t is not None}
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(marks.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest(), kept))
    return sorted(out, key=str)


def check(spark, conversations):
    data = [(c, t, r, x, 1, 2, "e", 3) for c, rows in conversations.items() for t, r, x in rows]
    rows, edited = R.repair(spark.createDataFrame(data, SCHEMA).repartition(7))
    want = expected(conversations)
    assert sorted(map(tuple, R.digests(rows, edited).collect()), key=str) == [w[:-1] for w in want]
    turns = {}
    for r in R.repaired_turns(rows, edited).collect():
        turns.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"]))
    assert {c: [x[1:] for x in sorted(t)] for c, t in turns.items()} == {w[0]: list(w[-1]) for w in want if w[-1]}


@pytest.mark.parametrize("fragment", [1, 4, 1024])
def test_fragments_do_not_change_results(spark, monkeypatch, fragment):
    monkeypatch.setattr(R, "FRAGMENT", fragment)
    rng = random.Random(3)
    convs = {c: [(i, *x) for i, x in enumerate(some(rng, rng.randint(1, 9)))] for c in range(40)}
    convs[100] = [(i, *x) for i, x in enumerate(some(rng, 90))]
    check(spark, convs)


def test_a_conversation_with_most_rows(spark):
    rng = random.Random(4)
    hot = [(i, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", f"t {i}.", f"cut {i}", ""])) for i in range(4000)]
    check(spark, {1: hot, 2: [(0, "user", "a."), (1, "assistant", "b.")]})


def test_odd_rows(spark):
    check(spark, {None: [(None, None, None), (None, "user", "a."), (3, "user", "a.")],
                  1: [(5, "user", "x."), (5, "user", "x."), (9, "assistant", "y" * 200_000 + ". \n")],
                  2: [(0, "system", "only.")], 3: [(0, "user", " \x0b")], 4: [(None, "assistant", "é.")], 5: [(2, "", "z.")]})


def test_empty_table(spark):
    rows, edited = R.repair(spark.createDataFrame([], SCHEMA))
    assert R.digests(rows, edited).count() == 0 and R.repaired_turns(rows, edited).count() == 0


def test_damage(spark, tmp_path):
    rows = [(c, t, "assistant" if t else None, f"Say {t}. Yes! No?") for c in range(60) for t in range(8)]
    rows += [(None, None, None, None), (7, None, "user", None), (None, 3, "user", "a.")]
    left = []
    for c, t, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        role, text = name(role), name(text)
        if fate:
            row = (c, t, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            left += [row] * (2 if fate == 3 else 1)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, R.damage(turns).collect()), key=str) == sorted(left, key=str)
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, R.op13_conversation_repair(spark, str(tmp_path)).collect()), key=str)
    convs = {c: [] for c, *_ in rows}
    for c, *rest in left:
        convs[c].append(tuple(rest))
    assert got == [w[:-1] for w in expected(convs)]
