from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

from eventloom.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def marked(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(BLANK)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def searched(rows):
    """(cost, audit, repaired lines) by trying all edits, cheapest first."""
    rows, budget = marked(rows), 0
    while True:
        found = []

        def go(i, left, audit, roles, lines):
            if i == len(rows) and left == 0 and LEGAL.fullmatch(roles):
                found.append((audit, lines))
            if left >= 3:
                for role in ("user", "assistant"):
                    if not re.search(r"uu|aa|sa|.s|^a", roles + role[0]):
                        go(i, left - 3, audit + "I", roles + role[0], [*lines, f"{role}:"])
            if i == len(rows):
                return
            role, text, fault = rows[i]
            if left >= 4:
                go(i + 1, left - 4, audit + "D", roles, lines)
            if fault in ("blank", "duplicate"):
                return
            more = 3 if fault else 0
            for letter, cost, name in (("K", more, role), ("R", 3 + more, "user"), ("R", 3 + more, "assistant")):
                if cost <= left and not re.search(r"[^sua]|uu|aa|sa|.s|^a", roles + (name[:1] or "-")):
                    go(i + 1, left - cost, audit + letter, roles + name[0], [*lines, f"{name}:{text}"])

        go(0, budget, "", "", [])
        if found:
            audit, lines = min(found)
            return budget, audit, lines
        budget += 1


def report(spark, rows, kind="report"):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.selectExpr("*", "'x' AS fault", "2 AS at", "'y' AS seg").repartition(3)
    return {r.conv_id: r for r in getattr(repair, kind)(frame).collect()}


def test_against_a_search(spark):
    rng = random.Random(11)
    texts = ["fine.", "ok!", "cut", "", "  ", "why?\n"]
    roles = ["user", "assistant", "system", "tool", "", "user", "assistant"]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(120) for t in range(rng.randrange(1, 5))]
    found = report(spark, rows)
    for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
        own = [r[2:] for r in own]
        cost, audit, lines = searched(own)
        got, kinds = found[conv], [f for _, _, f in marked(own)]
        assert (got.cost, got.audit) == (cost, audit), own
        assert got.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert (got.blank, got.duplicate, got.truncated) == tuple(map(kinds.count, ("blank", "duplicate", "truncated")))
        letters = [r[:1] for r, _ in own]
        assert got.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))


def plain_dp(classes, faults):
    """Cost and audit, one message at a time."""
    best = [(repair.AT_END[p], "I" * (repair.AT_END[p] // 3)) for p in repair.STATES]
    for role, fault in zip(reversed(classes), reversed(faults)):
        own = [min((c + best[q][0], e + best[q][1]) for e, c, q in repair._edits(role, fault, p)) for p in repair.STATES]
        best = list(own)
        for _ in range(2):
            step = [repair.NEXT[p, repair.WANTED[p]] for p in repair.STATES]
            best = [min(own[p], (3 + best[step[p]][0], "I" + best[step[p]][1])) for p in repair.STATES]
    return best[0]


def test_runs_and_segments_equal_single_steps():
    rng = random.Random(2)
    for _ in range(60):
        symbols = [(rng.choice("sua-"), rng.choice("0012"), rng.choice([1, 2, 40, 333])) for _ in range(6)]
        classes = "".join(c * n for c, _, n in symbols)
        faults = "".join(f * n for _, f, n in symbols)
        cost, audit = plain_dp(classes, faults)
        steps, state = repair.unroll(classes, faults, repair.AT_END, 0)
        assert "".join(e for e, _ in steps) + "I" * len(repair._completion(state)) == audit
        matrix = repair.IDENTITY
        for low in range(0, len(classes), 100):
            part = repair.segment_matrix(classes[low : low + 100], faults[low : low + 100])
            matrix = repair._times(matrix, part)
        assert repair._applied(matrix, repair.AT_END)[0] == cost


def test_one_conversation_over_many_segments(spark, monkeypatch):
    """Also a message repeated many times, at one turn."""
    monkeypatch.setattr(repair, "SEGMENT_BITS", 4)
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"m{t}{rng.choice('.x')}") for t in range(300)]
    rows += [(1, 300, "user", "again.")] * 100 + [(2, None, "user", "a."), (2, 0, "assistant", "b.")]
    found = report(spark, rows)
    kinds = marked([r[2:] for r in rows if r[0] == 1])
    classes = "".join(r[0] for r, _, _ in kinds)
    faults = "".join({"": "0", "truncated": "2"}.get(f, "1") for _, _, f in kinds)
    assert (found[1].cost, found[1].audit) == plain_dp(classes, faults)
    assert found[1].duplicate == 99 and found[1].gaps == 0
    assert (found[2].audit, found[2].cost, found[2].illegal) == ("KK", 0, 0)


def test_nulls_and_empty(spark):
    rows = [
        (None, 1, "user", "q?"),
        (None, 4, "assistant", None),
        (7, None, None, "x" * 100_000),
        (7, None, "user", " \n"),
        (8, None, "user", None),
    ]
    found = report(spark, rows)
    assert (found[None].gaps, found[None].blank, found[None].audit, found[None].cost) == (2, 1, "KDI", 7)
    assert (found[7].gaps, found[7].truncated, found[7].blank, found[7].audit) == (0, 1, 1, "DD")
    assert (found[8].gaps, found[8].audit, found[8].repaired_sha256) == (0, "D", hashlib.sha256(b"").hexdigest())
    assert report(spark, []) == {} and report(spark, [], "damage_report") == {}


def test_damage(spark):
    """Every kind of damage, and conversations left without messages."""
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in (*range(8), None)] + [(None, None, None, None)]
    kinds = {(c, t): zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, _, _ in rows}
    kept = {}
    for c, t, role, text in rows:
        kind = kinds[c, t]
        text = "" if kind == 1 else "One Two Three" if kind == 2 else " " if text is None else text
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            kept.setdefault(c, []).append((t, "user" if kind == 4 else role or " ", text))
    gone = next(c for c in itertools.count(10**6) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    found = report(spark, [*rows, (gone, 1, "user", "a.")], "damage_report")
    assert set(found) == {r[0] for r in rows} | {gone}
    assert tuple(found[gone])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for conv, own in kept.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        faults = [f for _, _, f in marked([r[1:] for r in own])]
        got, turns = found[conv], [t for t, _, _ in own if t is not None]
        assert (got.blank, got.duplicate, got.truncated) == tuple(map(faults.count, ("blank", "duplicate", "truncated")))
        assert got.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
