"""Conversation repair against an exhaustive search over edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from shroud.llm import dialogue

ROWS = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def brute_edits(rows):
    """Least cost, then least letters: every string of edits in order of (cost, letters), states as role strings."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, letters, i, last = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, letters
        if (i, last) in done:  # popped in order of cost and letters; a longer one of equal cost has the popped as no prefix
            continue
        done.add((i, last))
        fit = NEXT[last]
        heapq.heappush(heap, (cost + 2, letters + "I", i, fit))
        if i < len(rows):
            initial, must_go, cut = rows[i]
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, last))
            if not must_go:
                if initial == fit or (initial == "s" and last == ""):
                    heapq.heappush(heap, (cost + cut, letters + "K", i + 1, initial))
                heapq.heappush(heap, (cost + 2 + cut, letters + "R", i + 1, fit))


def all_edits(rows, most):
    """Every edit string up to a cost, by plain recursion."""
    best = None

    def go(i, last, cost, letters):
        nonlocal best
        if cost > most:
            return
        if i == len(rows) and last in ("", "a"):
            best = min(best, (cost, letters)) if best else (cost, letters)
        fit = NEXT[last]
        go(i, fit, cost + 2, letters + "I")
        if i < len(rows):
            initial, must_go, cut = rows[i]
            go(i + 1, last, cost + 3, letters + "D")
            if not must_go:
                if initial == fit or (initial == "s" and last == ""):
                    go(i + 1, initial, cost + cut, letters + "K")
                go(i + 1, fit, cost + 2 + cut, letters + "R")
    go(0, "", 0, "")
    return best


def code(initial, must_go, cut):
    return 3 * {"s": 0, "u": 1, "a": 2}.get(initial, 3) + (1 if must_go else 2 if cut else 0)


def random_rows(rng, n):
    return [(rng.choice("uuaasx"), rng.random() < .2, rng.random() < .3) for _ in range(n)]


def test_every_short_conversation():
    rng = random.Random(1)
    for _ in range(250):
        rows = random_rows(rng, rng.randrange(0, 6))
        cost, letters = dialogue.cheapest_edits(bytes(code(*r) for r in rows), rng.choice([1, 2, 16]))
        assert (cost, letters) == all_edits(rows, cost)


def test_blocks_do_not_change_the_path():
    rng = random.Random(2)
    for n in (15, 16, 17, 33, 120):
        codes = bytes(code(*r) for r in random_rows(rng, n))
        assert len({dialogue.cheapest_edits(codes, b) for b in (1, 5, 16, 500)}) == 1


def test_long_conversation_takes_linear_time():
    rng = random.Random(3)
    codes = bytes(code(*r) for r in random_rows(rng, 30_000))
    cost, letters = dialogue.cheapest_edits(codes)
    assert len(letters) - letters.count("I") == 30_000 and cost > 0


def brute_report(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        here = convs[c]
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        here += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    out = {}
    for c, here in convs.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, count, states = set(), [0, 0, 0], []
        for _, r, x in here:
            left = re.sub(r"[\x20\x09-\x0D]+", "", x)
            fault = 0 if not left else 1 if (r, x) in seen else 2 if left[-1] not in ".!?" else None
            seen.add((r, x))
            if fault is not None:
                count[fault] += 1
            states.append((r[:1], fault in (0, 1), fault == 2))
        turns = [t for t, _, _ in here if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(states, states[1:]))
        cost, letters = brute_edits(states) if here else (0, "")
        lines, i, last = [], 0, ""
        for e in letters:
            fit = NEXT[last]
            if e == "I":
                lines.append({"u": "user", "a": "assistant"}[fit] + ":")
                last = fit
                continue
            _, r, x = here[i]
            i += 1
            if e == "D":
                continue
            if e == "R":
                r = {"u": "user", "a": "assistant"}[fit]
            last = r[0]
            lines.append(f"{r}:{x}")
        out[c] = (gaps, *count, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = ["Yes.", "Why?", "cut off", "", " \t", "Go!", None, "Same.", "é…", "end. \n"]
    out = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), rng.choice(texts))
           for c in range(60) for t in sorted(rng.sample(range(14), rng.randrange(1, 9)))]
    out += [(None, t, "user", "Hm.") for t in range(4)] + [(100, None, "user", "x."), (100, None, "assistant", "y."), (100, 3, "user", "z")]
    out += [(101, t, ("user", "assistant")[t % 2], f"Text {t}.") for t in range(300)]
    lone = next(c for c in range(200, 999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*out, (lone, 0, "user", "Gone."), (102, 1, "user", "long " * 60_000 + "."), (102, 2, "assistant", "ok.")]


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_report_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in dialogue.repair_report(df).collect()}
    assert got == brute_report(rows)
    shuffled = spark.createDataFrame(random.Random(5).sample(rows, len(rows)), ROWS).selectExpr("*", "1 AS audit", "2 AS key", "3 AS part")
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in dialogue.repair_report(shuffled).collect()} == got


def test_repaired_rows_have_the_structure(spark, rows):
    d = dialogue.damage(spark.createDataFrame(rows, ROWS))
    found = defaultdict(list)
    for r in dialogue.repaired(d, dialogue.audit(d)).collect():
        found[r.conv_id].append((r.place, r.role))
    for places in found.values():
        assert [p for p, _ in places] == list(range(1, len(places) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r in places))


def test_empty_table(spark):
    assert dialogue.repair_report(spark.createDataFrame([], ROWS)).collect() == []
