"""Subword lattice scores against sums over all segmentations."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from shroud.llm import lattice

DOCS = "doc_id long, text string, lang string"
PATH = public_tokenizers.path("piece_bpe_32k.model")
TINY = lattice.vocabulary([(p.encode(), -float(i), True) for i, p in enumerate([" ", "a", "b", "ab", " a", "ba", "aba", " ab", "é", "abab"])])


def all_segmentations(word, weight):
    """Sum over every way of cutting, by recursion over the rest."""
    if not word:
        return 1.0
    return sum(weight[word[:n]] * all_segmentations(word[n:], weight) for n in range(1, len(word) + 1) if word[:n] in weight)


def test_sum_over_all_segmentations():
    weight = dict(zip(TINY.pieces, TINY.weight))
    words = ["".join(w).encode() for n in range(1, 7) for w in itertools.product("abé", repeat=n)][:400] + [b"x", b"", "☃ab".encode()]
    got, _ = lattice.Lattice(TINY.pieces).run(words, np.log(TINY.weight[:-1]))
    want = [math.log(all_segmentations(b" " + w, weight)) for w in words]
    assert np.allclose(got, want, rtol=1e-12)


def test_expected_draws():
    """Counts of pieces over all segmentations, each with its share of the word's probability."""
    weight = dict(zip(TINY.pieces, TINY.weight))

    def ways(word):
        if not word:
            yield 1.0, ()
        for n in range(1, len(word) + 1):
            if word[:n] in weight:
                yield from ((weight[word[:n]] * p, (word[:n], *rest)) for p, rest in ways(word[n:]))
    words, counts = [b"abab", b"ba", b"a", b"babab"], np.array([3.0, 1.0, 5.0, 2.0])
    want = Counter()
    for w, c in zip(words, counts):
        found = list(ways(b" " + w))
        for p, pieces in found:
            for x in pieces:
                want[x] += c * p / sum(q for q, _ in found)
    _, got = lattice.Lattice(TINY.pieces).run(words, np.log(TINY.weight[:-1]), counts)
    assert np.allclose(got, [want[p] for p in TINY.pieces], rtol=1e-10)


def test_long_words_go_byte_by_byte():
    net, logp = lattice.Lattice(TINY.pieces), np.log(TINY.weight[:-1])
    words = [b"ab" * 31, b"ab" * 32, b"ab" * 40, b"a" * 63, b"a" * 64]
    want, draws = net.run(words, logp, np.ones(5))
    old, lattice.MATRIX = lattice.MATRIX, 0
    try:
        got, other = net.run(words, logp, np.ones(5))
    finally:
        lattice.MATRIX = old
    assert np.allclose(got, want) and np.allclose(draws, other)
    assert net.run([b"ab" * 60_000], logp)[0][0] < want[0]


def test_texts_share_at_most_the_whole_probability():
    """All texts of up to three words of one or two letters, their probabilities summed."""
    vocab = lattice.vocabulary([(b" ", 0.0, True), (b"a", -1.0, True), (b" a", -2.0, True)])
    net, logp = lattice.Lattice(vocab.pieces), np.log(vocab.weight[:-1])
    letters = [bytes([b]) for b in range(256) if b not in b" \t\n\x0b\x0c\r" and not 65 <= b <= 90]
    one = np.exp(net.run([b"", *letters, *(a + b for a in letters for b in letters)], logp)[0]).sum()
    assert sum(one ** n for n in range(4)) * vocab.weight[-1] < 1.0


def test_vocabulary_file():
    v = lattice.load_vocabulary(PATH)
    assert len(v.pieces) == len(set(v.pieces)) and abs(v.weight.sum() - 1) < 1e-9 and (v.weight > 0).all()
    assert not any(re.search(rb"[A-Z\t\n\r]|. ", p) for p in v.pieces) and len(v.pieces) > 10_000
    logged = lattice.vocabulary([(b" ", math.log(0.5), True), (b"a", math.log(0.4), True), (b"b", math.log(0.1), True)])
    assert logged.weight[0] / logged.weight[1] == pytest.approx(1.25)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    stock = ["oak", "Elm", "ash", "fir", "bay", "straße", "Über", "naïve", "x-y", "…", "a" * 90, "Ünder"]
    rows = [(i, " ".join(rng.choice(stock) + rng.choice(["", "", str(rng.randrange(90))]) for _ in range(rng.randrange(1, 60))), "en") for i in range(80)]
    return [*rows, (90, None, "en"), (91, "", None), (92, " \n", "de"), (None, "oak oak", "en"), (3, rows[3][1], "en"), (3, "other text", "en"),
            (93, "unseen-" + "q" * 4000, "en"), (94, " ".join(f"w{i}" for i in range(30_000)), "en")]


def expected(corpus):
    fold = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 for d, _, _ in corpus]
    lower = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t, _ in corpus]
    count = Counter()
    for f, w in zip(fold, lower):
        if f != 1:
            count.update([*w, None])
    n, v = sum(count.values()), len(count)
    for (d, _, _), f, w in zip(corpus, fold, lower):
        t = [*w, None]
        yield d, f == 1, len(t), sum(x in count for x in t), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), w


@pytest.mark.parametrize("head", [1 << 19, 40, 0])
def test_scores_equal_brute_force(spark, corpus, head):
    """Whole vocabulary in the head, most words joined, and all words joined."""
    got = lattice.score_texts(spark.createDataFrame(corpus, DOCS), PATH, head=head, rounds=1).collect()
    want = list(expected(corpus))
    key = lambda r: (r[0] is None, r[0], r[2], r[5])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(a)[:5] == b[:5] and a.base_score == pytest.approx(b[5], rel=1e-9)
    vocab = lattice.load_vocabulary(PATH)
    net, count = lattice.Lattice(vocab.pieces), Counter()
    for d, held, *_, w in want:
        if not held:
            count.update([x.encode() for x in w])
    words = sorted(count)
    drawn = 100 * vocab.weight
    drawn[:-1] += net.run(words, np.log(vocab.weight[:-1]), np.array([count[w] for w in words], float))[1]
    drawn[-1] += sum(not r[1] for r in want)
    logw = np.log10(drawn / drawn.sum())
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        own = net.run([x.encode() for x in b[6]], logw[:-1] * math.log(10))[0].sum() / math.log(10) if b[6] else 0.0
        assert a.score == pytest.approx(own + logw[-1], rel=1e-8)


def test_rounds_raise_the_likelihood(spark, corpus):
    df = spark.createDataFrame(corpus, DOCS).filter("doc_id < 80")
    total = [sum(r.score for r in lattice.score_texts(df, PATH, rounds=k).collect() if not r.held_out) for k in (0, 1, 3)]
    assert total[0] < total[1] < total[2]


def test_empty_and_untrained(spark):
    assert lattice.score_texts(spark.createDataFrame([], DOCS), PATH).collect() == []
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lattice.score_texts(spark.createDataFrame([(only, "a b", "en")], DOCS), PATH).first()
    assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0.0 and r.score < 0
