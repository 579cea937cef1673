"""Conversation repair against plain searches over audits written out as strings."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from stayflow.llm import dialogue_repair as D

SF = "/root/testdata/sf0.001"
LEGAL = re.compile("(s?(ua)+)?")


def brute(rows):
    """All audits by cost, then letters: a search that knows nothing of states, only the roles written so far."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, done, roles = heapq.heappop(heap)
        if (edits, done, roles) in seen:
            continue
        seen.add((edits, done, roles))
        if done == len(rows) and LEGAL.fullmatch(roles):
            return cost, edits
        if any(LEGAL.fullmatch(roles + more) for more in ("", "a", "ua")) is False:
            continue
        for r in "ua":
            heapq.heappush(heap, (cost + 2, edits + "I", done, roles + r))
        if done < len(rows):
            initial, fault = rows[done]
            heapq.heappush(heap, (cost + 3, edits + "D", done + 1, roles))
            if fault not in (D.BLANK, D.DUPLICATE):
                extra = 1 if fault == D.CUT else 0
                heapq.heappush(heap, (cost + extra, edits + "K", done + 1, roles + (initial or "?")))
                for r in "ua":
                    heapq.heappush(heap, (cost + 2 + extra, edits + "R", done + 1, roles + r))
    raise AssertionError


def by_strings(rows):
    """The same four states with whole strings."""
    def inserted(live):
        changed = True
        while changed:
            changed = False
            for s, held in list(live.items()):
                new = (held[0] + 2, held[1] + "I")
                if D.spoken(s) not in live or new < live[D.spoken(s)]:
                    live[D.spoken(s)], changed = new, True
        return live

    live = inserted({D.START: (0, "")})
    for initial, fault in rows:
        after = {}
        for s, (cost, edits) in live.items():
            options = [(s, cost + 3, "D")]
            if fault not in (D.BLANK, D.DUPLICATE):
                extra = int(fault == D.CUT)
                options.append((D.spoken(s), cost + 2 + extra, "R"))
                if D.kept(s, initial) is not None:
                    options.append((D.kept(s, initial), cost + extra, "K"))
            for to, c, letter in options:
                after[to] = min(after.get(to, (c, edits + letter)), (c, edits + letter))
        live = inserted(after)
    return min(live[s] for s in (D.START, D.ASSISTANT) if s in live)


def conversations(n, most, letters="suaut"):
    rng = random.Random(n * 31 + most)
    for _ in range(n):
        yield [(rng.choice(letters), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(0, most + 1))]


def test_short_conversations_against_all_audits():
    for rows in conversations(250, 5):
        assert D.audit(rows) == brute(rows), rows


@pytest.mark.parametrize("modulus,every", [(D.MODULUS, 256), (D.MODULUS, 1), (3, 5), (1, 7)])
def test_long_conversations_with_and_without_hash_collisions(monkeypatch, modulus, every):
    monkeypatch.setattr(D, "MODULUS", modulus)
    monkeypatch.setattr(D, "FINAL_EVERY", every)
    for letters in ("suaut", "ua", "t", "uat", "ssua", "aau"):
        for rows in conversations(40, 90, letters):
            assert D.audit(rows) == by_strings(rows), rows


def test_shared_prefix_search(monkeypatch):
    rng = random.Random(2)
    for modulus in (D.MODULUS, 5):
        monkeypatch.setattr(D, "MODULUS", modulus)
        nodes = [(D.Edit("", None), "")]
        for _ in range(400):
            node, text = rng.choice(nodes[-40:])
            letter = rng.choice("DIK")
            nodes.append((D.Edit(letter, node), text + letter))
        for _ in range(3000):
            (a, x), (b, y) = rng.choice(nodes), rng.choice(nodes)
            n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert D.shared(a, b) == n and (D.less(a, b) == (x < y) or x == y)


def test_settled_edits_are_let_go():
    talk, said = D.Conversation(lambda *a: None), 0
    for i in range(20_000):
        talk.row(i, "user" if i % 2 == 0 else "assistant", "Yes.", 0)
        said = max(said, len(talk.waiting))
    assert said < 4 * D.FINAL_EVERY
    assert talk.end()[-2:] == [0, "K" * 20_000]


def damaged(rows):
    """(conv, turn, role, text) after the contract's damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def expected(conv, rows):
    said = [r[1:] for r in damaged(rows) if r[0] == conv]
    seen, typed = set(), []
    for _, role, text in said:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = D.BLANK if not last else D.DUPLICATE if (role, text) in seen else D.CUT if last[-1] not in ".!?" else D.OK
        seen.add((role, text))
        typed.append((role[:1], fault))
    turns = [t for t, _, _ in said if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(typed, typed[1:]))
    cost, edits = by_strings(typed)
    state, at, lines = D.START, 0, []
    for e in edits:
        if e != "I":
            _, role, text = said[at]
            at += 1
        if e == "D":
            continue
        if e == "K":
            state = D.kept(state, role[:1])
        else:
            state = D.spoken(state)
            role, text = "user" if state == D.USER else "assistant", "" if e == "I" else text
        lines.append(f"{role}:{text}")
    faults = [f for _, f in typed]
    return (conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_query_matches_brute_force(spark, tmp_dir):
    rng = random.Random(9)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    texts = ["Yes.", "No", "", None, " \t", "Why?", "Why?", "é!", "a\nb. \x0b", "x" * 3000 + "."]
    rows += [(1000 + rng.randrange(60), rng.choice([None, -3, 0, 1, 2, 3, 4, 9, 2**31 - 1]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(texts)) for _ in range(500)]
    rows += [(None, t, "user", "Null id.") for t in (None, 1, 2)] + [(5000, i, "user" if i % 2 else "tool", rng.choice(texts)) for i in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "role as fault", "text as hit", "turn as of", "1 as copy")
    df.repartition(5).write.parquet(tmp_dir + "/t/conversations.parquet")
    out = D.op13_dialogue_repair(spark, tmp_dir + "/t")
    want = {c: expected(c, [r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    got = {r.conv_id: tuple(r) for r in out.collect()}
    assert got == want
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_conversation_of_dropped_rows_and_empty_table(spark, tmp_dir):
    gone = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    schema = "conv_id long, turn int, role string, text string"
    spark.createDataFrame([(*gone, "user", "Hi.")], schema).write.parquet(tmp_dir + "/a/conversations.parquet")
    assert [tuple(r) for r in D.op13_dialogue_repair(spark, tmp_dir + "/a").collect()] == [
        (gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    spark.createDataFrame([], schema).write.parquet(tmp_dir + "/b/conversations.parquet")
    assert D.op13_dialogue_repair(spark, tmp_dir + "/b").count() == 0


def test_repaired_messages(spark):
    rows = [("c", 1, "assistant", "Hello."), ("c", 2, "user", "Hi"), ("c", 3, "user", "Hi"), ("c", None, "system", "Rules."), (None, 1, "user", "Yes.")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    out = D.repair(df).collect()
    said = {}
    for r in sorted(out, key=lambda r: (r.conv_id or "", r.nth)):
        said.setdefault(r.conv_id, []).append((r.edit, r.turn, r.role, r.text))
    assert said[None] == [("K", 1, "user", "Yes."), ("I", None, "assistant", "")]
    assert LEGAL.fullmatch("".join(m[2][0] for m in said["c"]))
    assert D.repair(df.limit(0)).count() == 0
