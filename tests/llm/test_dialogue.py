"""Conversation repair against a search over all edit strings."""

import hashlib
import heapq
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F
from weir.llm import dialogue
from weir.llm.queries import op13_audit_repair

ROLE = {"s": "system", "u": "user", "a": "assistant", "t": "tool", " ": " "}
WS = " \t\n\x0b\x0c\r"


def _legal(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(rest) >= 2 and rest == "ua" * (len(rest) // 2))


def _open(initials):
    """Whether a legal string can begin like this."""
    rest = initials[1:] if initials[:1] == "s" else initials
    return rest == ("ua" * len(rest))[: len(rest)]


def brute(rows):
    """Cost, audit and repaired rows: cheapest first, then ASCII order, over all edit strings."""
    queue, tick = [(0, "", 0, "", 0, ())], itertools.count()
    while queue:
        cost, audit, i, initials, _, out = heapq.heappop(queue)
        if i == len(rows) and _legal(initials):
            return cost, audit, out
        nexts = [("I", 2, i, ROLE[c], "") for c in "ua"]
        if i < len(rows):
            role, text, fault = rows[i]
            nexts.append(("D", 3, i + 1, None, None))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                nexts.append(("K", more, i + 1, role, text))
                nexts += [("R", 2 + more, i + 1, ROLE[c], text) for c in "ua"]
        for letter, more, j, role, text in nexts:
            now = initials + (role[:1] if role is not None else "")
            if role == "" or not _open(now):
                continue
            heapq.heappush(queue, (cost + more, audit + letter, j, now, next(tick),
                                   out if role is None else (*out, f"{role}:{text}")))


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        ended = text.rstrip(WS)
        fault = "blank" if not ended else "duplicate" if (role, text) in seen else "truncated" if ended[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(rows):
    """rows: (turn, role, text) after damage, in order."""
    marked = _faults(rows)
    cost, audit, out = brute(marked)
    turns = [t for t, _, _ in rows if t is not None]
    count = {f: sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")}
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **count,
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}


def _damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fold = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fold == 0:
            continue
        if fold == 1:
            text = ""
        if fold == 2:
            text = "".join(x for x in text if x not in ".!?")
        out += [(c, t, "user" if fold == 4 else role, text)] * (2 if fold == 3 else 1)
    return out


def test_audit_equals_search_over_all_edits():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(i, ROLE[rng.choice("suuaat ")], rng.choice(["a.", "b!", "c?", "d", " \t", "", "e. "]))
                for i in range(rng.randint(0, 6))]
        audit = dialogue.Audit()
        for role, _, fault in (marked := _faults(rows)):
            audit.row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        assert audit.finish() == brute(marked)[:2], rows


def test_given_out_early_or_late_is_the_same(monkeypatch):
    rng = random.Random(6)
    for _ in range(60):
        rows = [(i, ROLE[rng.choice("suuaat")], rng.choice(["a.", "b!", "c", " "]) + str(i) * (rng.random() < 0.7) + ".")
                for i in range(rng.randint(50, 300))]
        got = []
        for window in (3, 10_000):
            monkeypatch.setattr(dialogue, "WINDOW", window)
            edits = []
            conv = dialogue.Conversation(1, lambda *e: edits.append(e))
            for (t, role, text), (_, _, fault) in zip(rows, _faults(rows)):
                conv.row(t, role, text, fault == "blank", fault == "duplicate", fault == "truncated")
            got.append((conv.finish(), edits))
        assert got[0] == got[1]


def test_hash_collisions_are_verified(monkeypatch):
    monkeypatch.setattr(dialogue, "MODULUS", 1)
    test_audit_equals_search_over_all_edits()


def test_window_stays_small_in_a_long_conversation():
    rng, given = random.Random(7), []
    conv = dialogue.Conversation(1, lambda *e: given.append(e[2]))
    widest = 0
    for i in range(20_000):
        role = ROLE["ua"[i % 2]] if rng.random() < 0.9 else ROLE[rng.choice("sut")]
        conv.row(i, role, "x.", rng.random() < 0.05, False, False)
        widest = max(widest, len(conv.waiting))
    assert widest <= dialogue.WINDOW + 8
    conv.finish()
    assert sum(e != "I" for e in given) == 20_000


def _table():
    rng = random.Random(9)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, ROLE[rng.choice("suaua")], rng.choice(["Hm.", "So!", "And", "", None, "x" * 50_000 + "?"]) or None))
    rows += [(None, 0, "user", "a."), (None, 1, None, "b."), (500, None, "user", "a."), (500, None, "assistant", "b."),
             (501, 3, "user", "q."), (501, 3, "user", "q."), (501, 7, "assistant", "q."), (502, 1, "", "z.")]
    return rows


def test_query_on_damaged_table(spark, tmp):
    rows = _table()
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "conv_id long, turn long, role string, text string, present int")
    df.write.parquet(f"{tmp}/conversations.parquet")
    got = {r.conv_id: r.asDict() for r in op13_audit_repair(spark, tmp).collect()}
    kept = {}
    for c, *r in _damage(rows):
        kept.setdefault(c, []).append(tuple(r))
    assert set(got) == {r[0] for r in rows}
    for c in got:
        mine = sorted(kept.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        assert got[c] == {"conv_id": c, **expected(mine)}, (c, mine)


def test_repair_gives_legal_conversations(spark):
    rows = _table()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits = {}
    for r in dialogue.repair(df).collect():
        edits.setdefault(r.conv_id, []).append(r)
    audit = {r.conv_id: r for r in dialogue.audits(df).collect()}
    assert set(edits) == set(audit) == {r[0] for r in rows}
    for c, es in edits.items():
        es.sort(key=lambda r: r.step)
        assert [e.step for e in es] == list(range(len(es))) and "".join(e.edit for e in es) == audit[c].audit
        out = [e for e in es if e.edit != "D"]
        assert _legal("".join(e.role[:1] for e in out))
        assert hashlib.sha256("\n".join(f"{e.role}:{e.text}" for e in out).encode()).hexdigest() == audit[c].repaired_sha256


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dialogue.audits(df).collect() == [] and dialogue.repair(df).collect() == []
    gone = spark.createDataFrame([(4, 1, "user", "a.")], "conv_id long, turn long, role string, text string")
    (r,) = dialogue.audits(gone, present=F.lit(False)).collect()
    assert (r.audit, r.cost, r.gaps, r.repaired_sha256) == ("", 0, 0, hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("letters", [("ID", "DI"), ("KKR", "KKD"), ("K" * 300 + "D", "K" * 300 + "I")])
def test_order_of_nodes(letters):
    def node(text):
        n = dialogue.Node()
        for c in text:
            n = dialogue.Node(n, c)
        return n
    a, b = map(node, letters)
    assert dialogue.smaller(a, b) == (letters[0] < letters[1]) and dialogue.smaller(b, a) == (letters[1] < letters[0])
    assert a.letters() == letters[0]
