"""Tag propagation along lineage against a plain walk, and the number of rounds it takes."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shroud.operators import audit

EDGES = "src_table string, src_column string, dst_table string, dst_column string"
SEED = "table_id string, column_name string, key string, value string"


def walk(edges, seed):
    after = defaultdict(set)
    for a, b, c, d in edges:
        after[a, b].add((c, d))
    found, left = set(seed), list(seed)
    while left:
        t, c, k, v = left.pop()
        for to in after[t, c]:
            if (*to, k, v) not in found:
                found.add((*to, k, v))
                left.append((*to, k, v))
    return found


def propagated(spark, edges, seed):
    out = audit.propagate_tags(spark.createDataFrame(edges, EDGES), spark.createDataFrame(seed, SEED)).collect()
    assert len(out) == len(set(map(tuple, out)))
    return set(map(tuple, out))


@pytest.mark.parametrize("n", [12, 40, 120])
def test_random_graphs(spark, n):
    rng = random.Random(n)
    names = [(f"t{i % 7}", f"c{i}") for i in range(60)]
    edges = [(*rng.choice(names), *rng.choice(names)) for _ in range(n)]  # loops, repeats, rings, chains
    seed = [(*rng.choice(names), "pii", f"v{i % 70}") for i in range(75)]  # more tags than bits in a row
    assert propagated(spark, edges, seed) == walk(edges, seed)


def chain(prefix, n):
    return [(prefix, f"c{i}", prefix, f"c{i + 1}") for i in range(n)]


def test_deep_chain_and_ring_take_few_rounds(spark, monkeypatch):
    """A chain of 5,000 steps with tags at both ends, and a ring of 1,000 that it feeds and that feeds a chain."""
    edges = [*chain("a", 5000), *chain("r", 999), ("r", "c999", "r", "c0"), ("a", "c5000", "r", "c500"), ("r", "c10", "z", "c0"), *chain("z", 50)]
    seed = [("a", "c0", "pii", "ssn"), ("a", "c4000", "pii", "mail"), ("r", "c3", "pii", "phone")]
    rounds = []
    merged = audit._merged
    monkeypatch.setattr(audit, "_merged", lambda *a: rounds.append(1) or merged(*a))
    assert propagated(spark, edges, seed) == walk(edges, seed)
    assert len(rounds) <= 20


def test_nothing_to_push(spark):
    assert propagated(spark, chain("a", 3), []) == set() and propagated(spark, [], [("a", "c", "k", "v")]) == {("a", "c", "k", "v")}


def test_rounds_move_only_what_can_change(spark, monkeypatch):
    """Rounds past the chains hold only ends of edges into joints, and chains take no round more once all have met their heads."""
    edges = [*chain("a", 8), ("b", "x", "a", "c5"), *chain("q", 30)]
    seed = [("a", "c0", "pii", "ssn"), ("b", "x", "pii", "mail"), *[("q", f"c{i}", "pii", "phone") for i in range(30)]]
    sizes = []
    merged = audit._merged
    monkeypatch.setattr(audit, "_merged", lambda facts, more: sizes.append(facts.count()) or merged(facts, more))
    assert propagated(spark, edges, seed) == walk(edges, seed)
    assert len(sizes) <= 8 and sizes[-1] <= 4


def test_columns_with_the_same_hash_stay_apart(spark, monkeypatch):
    """Ids fall back on numbers joined to names if two columns have the same hash."""
    rng = random.Random(8)
    names = [(f"t{i % 5}", f"c{i}") for i in range(30)]
    edges = [(*rng.choice(names), *rng.choice(names)) for _ in range(35)]
    seed = [(*rng.choice(names), "pii", f"v{i % 3}") for i in range(9)]
    monkeypatch.setattr(audit, "_hashed", lambda table, column: F.length(column).cast("long"), raising=False)
    assert propagated(spark, edges, seed) == walk(edges, seed)


def test_chain_rounds_write_only_columns_still_on_their_way(spark, monkeypatch):
    """Chains of two steps beside one of sixty: a column that has met its head is not written again."""
    edges = [e for i in range(200) for e in chain(f"s{i}", 2)] + chain("a", 60)
    seed = [(f"s{i}", "c0", "pii", "ssn") for i in range(200)] + [("a", "c0", "pii", "mail")]
    sizes, kept = [], audit.written

    def counted(df):
        out = kept(df)
        sizes.append(out.count())
        return out
    monkeypatch.setattr(audit, "written", counted)
    assert propagated(spark, edges, seed) == walk(edges, seed)
    assert sum(n > 300 for n in sizes) <= 5  # edges, columns, nodes, the first round
