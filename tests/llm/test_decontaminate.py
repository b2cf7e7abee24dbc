"""Decontamination of items of every size against an exhaustive comparison."""

import random

import numpy as np
import pyarrow as pa
import pytest

from shroud.llm import decontaminate as D


def distance(item, text):
    """Least edit distance of the item to any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        left, row = row, [i]
        for j, x in enumerate(text, 1):
            row.append(min(left[j] + 1, row[j - 1] + 1, left[j - 1] + (w != x)))
    return min(row)


def edits(words, at):
    """Every kind of one edit at a place."""
    yield [*words[:at], "changed", *words[at + 1:]]
    yield [*words[:at], *words[at + 1:]]
    yield [*words[:at], "added", *words[at:]]


def text_of(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def found_rows(index, texts):
    tok, rows = D.tokens(pa.array([" ".join(t) for t in texts], pa.large_string()))
    return {(r, i) for r, spans in index.find(tok, rows).items() for i, *_ in spans}


def index_of(items, **kw):
    return D.Index(list(range(len(items))), [" ".join(x) for x in items], 0.15, 0.99, 4, kw.get("most", 32), 5)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 7])
def test_short_items_are_all_found(size):
    rng = random.Random(size)
    items = [[f"i{size}x{k}x{j}" for j in range(size)] for k in range(40)]
    texts = []
    for k, x in enumerate(items):
        copies = [x] if size < 7 else [x, *(y for at in range(size) for y in edits(x, at))]
        texts += [(k, [*text_of(rng, rng.randrange(0, 30)), *y, *text_of(rng, rng.randrange(0, 30))]) for y in copies]
    got = found_rows(index_of(items), [t for _, t in texts])
    assert got == {(r, k) for r, (k, _) in enumerate(texts)}


def test_each_edit_position_of_small_items():
    rng = random.Random(9)
    lost = total = 0
    for size in (8, 9, 11, 13, 14, 15):
        items = [[f"j{size}x{k}x{j}" for j in range(size)] for k in range(12)]
        texts = [(k, [*text_of(rng, 40), *y, *text_of(rng, 40)]) for k, x in enumerate(items) for at in range(size) for y in edits(x, at)]
        got = found_rows(index_of(items), [t for _, t in texts])
        assert all(r < len(texts) and texts[r][0] == i for r, i in got)
        lost, total = lost + len(texts) - len(got), total + len(texts)
    assert lost <= 0.01 * total


@pytest.mark.parametrize("size", [16, 24, 40, 90, 300])
def test_recall_of_long_items_in_running_text(size):
    rng = random.Random(size)
    items = [text_of(rng, size) for _ in range(30)]
    texts = []
    for k, x in enumerate(items):
        for _ in range(4):
            y = list(x)
            for _ in range(rng.randrange(0, int(0.15 * size) + 1)):
                y = rng.choice(list(edits(y, rng.randrange(len(y)))))
            texts.append((k, [*text_of(rng, 150), *y, *text_of(rng, 150)]))
    got = found_rows(index_of(items), [t for _, t in texts])
    assert len(got & {(r, k) for r, (k, _) in enumerate(texts)}) >= 0.98 * len(texts)


def test_equals_the_exhaustive_comparison():
    """Items of 1 to 20 words over few distinct words, all classes searched exactly: no row differs."""
    rng = random.Random(3)
    few = [f"v{i}" for i in range(9)]
    items = [[rng.choice(few) for _ in range(rng.choice([1, 3, 5, 7, 8, 12, 20]))] for _ in range(25)]
    texts = [[rng.choice(few) for _ in range(rng.randrange(0, 60))] for _ in range(40)]
    texts += [[*texts[k], *items[k][:4], "x", *items[k][5:]] for k in range(20)]
    want = {(r, i) for r, t in enumerate(texts) for i, x in enumerate(items) if distance(x, t) <= int(0.15 * len(x))}
    assert found_rows(index_of(items, most=0), texts) == want


def test_parts_keep_one_unedited():
    x = np.arange(1, 41, dtype=np.uint64)
    assert len(D._spans(x, 7)) == 34 and len(D._spans(x, 41)) == 0
