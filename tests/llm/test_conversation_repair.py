"""Conversation repair against a search by least (cost, audit) over all edits."""

import hashlib
import heapq
import random
import time
from collections import Counter
from zlib import crc32

import pytest

from minewright.llm import conversation_repair as R

WS = " \t\n\x0b\x0c\r"
FITS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def cheapest(rows):
    """(cost, audit, repaired) by uniform-cost search; rows are (role, text, must go, penalty)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, said = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(said)
        for role in ("user", "assistant"):
            if (last, role[0]) in FITS:
                heapq.heappush(heap, (cost + 5, audit + "I", i, role[0], (*said, f"{role}:")))
        if i < len(rows):
            role, text, gone, penalty = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, said))
            if not gone:
                if (last, role[:1]) in FITS:
                    heapq.heappush(heap, (cost + penalty, audit + "K", i + 1, role[:1], (*said, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if (last, new[0]) in FITS:
                        heapq.heappush(heap, (cost + penalty + 1, audit + "R", i + 1, new[0], (*said, f"{new}:{text}")))
    raise AssertionError


def expected(conv_id, data):
    rows = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, cost_rows, blank, duplicate, truncated = set(), [], 0, 0, 0
    for _, role, text in rows:
        held = text.strip(WS)
        gone, penalty = True, 0
        if not held:
            blank += 1
        elif (role, text) in seen:
            duplicate += 1
        else:
            gone, penalty = False, 0 if held[-1] in ".!?" else 5
            truncated += penalty > 0
        seen.add((role, text))
        cost_rows.append((role, text, gone, penalty))
    known = [t for t, *_ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, said = cheapest(cost_rows)
    return (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def drawn(draw, n, conv_id):
    texts = ["Yes.", "No", "", " \t", "Why?", "Go on!  ", "Yes.", "so", "é語.", "x" * 40]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", " "]
    return [(conv_id, draw.choice([None, *range(12)]), draw.choice(roles), draw.choice(texts) + draw.choice(["", str(draw.randrange(99)) + "."])) for _ in range(n)]


def test_repair_equals_search_over_all_edits(spark):
    draw = random.Random(8)
    data = [row for c in range(250) for row in drawn(draw, draw.randint(1, 12), c)]
    data += drawn(draw, 6, None) + [(900, 1, None, None), (901, None, "user", "a."), (901, None, "assistant", "b.")]
    data += [(902, i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(700)]
    data += [(903, i, draw.choice(["user", "assistant"]), f"t{draw.randrange(900)}{draw.choice(['', '.'])}") for i in range(1500)]
    data += [(904, 7, "user", "same.")] * 600 + [(905, 1, "system", "only."), (906, 0, "assistant", "long." * 300_000)]
    turns = spark.createDataFrame([(*r, 1, "k") for r in data], "conv_id long, turn long, role string, text string, cost long, key string")
    got = Counter(tuple(r) for r in R.digests(R.repair(spark, turns.repartition(5))).collect())
    plain = {}
    for conv_id, turn, role, text in data:
        plain.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == Counter(expected(c, rows) for c, rows in plain.items())
    assert R.digests(R.repair(spark, turns.limit(0))).count() == 0


def test_damage_keeps_every_conversation(spark):
    data = [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {t}! Done.") for c in range(60) for t in range(3)]
    data += [(None, 1, "user", "x."), (70, None, None, None)]
    alone = next(c for c in range(1000, 9999) if crc32(f"{c}:0".encode()) % 20 == 0)
    data.append((alone, 0, "user", "dropped."))
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    damaged = R.damage(turns)
    got = {r.conv_id: tuple(r) for r in R.digests(R.repair(spark, damaged, damaged.dropped)).collect()}
    plain = {}
    for conv_id, turn, role, text in data:
        own = plain.setdefault(conv_id, [])
        role, text = role or " ", text or " "
        fault = crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            text = {1: "", 2: text.translate({ord(c): None for c in ".!?"})}.get(fault, text)
            own += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    assert got == {c: expected(c, rows) for c, rows in plain.items()}
    assert got[alone] == (alone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("piece", [1, 2, 3, 7])
def test_pieces_give_what_the_whole_gives(monkeypatch, piece):
    monkeypatch.setattr(R, "PIECE_ROWS", piece)
    draw = random.Random(piece)
    for case in range(60):
        rows = [(r[1], r[2], r[3]) for r in drawn(draw, draw.randint(1, 14), case)]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        conversation, seen, said = R._Conversation(case), set(), []
        for turn, role, text in rows:
            conversation.enter_turn(turn)
            key = f"{role}\0{text}".encode()
            if key not in seen:
                conversation.fresh.add(key)
                seen.add(key)
            said += conversation.add(turn, role, text, key)
        last, measured = conversation.finish()
        said += last
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in said).encode()).hexdigest()
        assert (case, *measured, digest) == expected(case, rows)
        assert "".join(e for *_, e in said) == measured[-1].replace("D", "")


def test_search_stays_near_linear():
    draw = random.Random(2)
    rows = [(draw.choice("uaaus"), draw.random() < 0.1, draw.choice([0, 0, 0, 5])) for _ in range(4000)]
    bounds = R.suffix_bounds(rows)
    start = time.process_time()
    cost, audit, _ = R.search(rows, bounds, R.START, R.ENDS)
    assert time.process_time() - start < 2 and cost >= bounds[0][R.START] and len(audit) >= 4000
