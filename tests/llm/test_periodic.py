"""Periodic runs against a search over all periods, and odd rows."""

import random

import numpy as np
import pytest

from pdloom.llm import periodic
from pdloom.llm.periodic import differences, inverse, periodic_runs, transform
from pdloom.llm.queries import with_planted_runs


def brute(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
    return sorted([(s, n, q) for (s, n), q in found.items()], key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def repetitive(seed):
    rnd = random.Random(seed)
    words = [str(rnd.randint(0, rnd.choice([1, 2, 5]))) for _ in range(rnd.choice([0, 1, 5, 30, 300]))]
    if words and rnd.random() < 0.7:
        a = rnd.randrange(len(words))
        p = 1 + (len(words) - a) // rnd.randint(3, 12)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_transform_round_trip_and_differences(monkeypatch):
    random_numbers = np.random.default_rng(0)
    rows = random_numbers.integers(0, periodic.PRIME, (3, 32)).astype(np.uint64)
    assert (inverse(transform(rows)) == rows).all()
    monkeypatch.setattr(periodic, "PIECE", 16)  # longer blocks are summed over pieces
    for size in (1, 2, 8, 64):
        u = random_numbers.integers(0, 9, (5, size))
        v = random_numbers.integers(0, 9, (5, 2 * size - 1))
        wanted = [[((u[r] - v[r, d : d + size]) ** 2).sum() for d in range(size)] for r in range(5)]
        assert (differences(u, v) == wanted).all()


@pytest.mark.parametrize("slice_bytes", [1, 4_000_000])
def test_runs_equal_the_search_over_all_periods(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(periodic, "SLICE", slice_bytes)
    texts = [repetitive(seed) for seed in range(300)]
    texts += [["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"], ["x"] * 5_000, ["p", "q", "r"] * 900]
    docs = spark.createDataFrame([(i, "\n ".join(w)) for i, w in enumerate(texts)], "doc_id int, text string")
    for row in periodic_runs(docs).collect():
        words = texts[row["doc_id"]]
        assert [tuple(r) for r in row["runs"]] == brute(words)
        assert row["n_words"] == len(words) and row["collapsed"] == collapsed(words, brute(words))


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (None, "a a a a a a", 0), (4, "é é é é é é z", 1),
            (4, "é é é é é é z", 1), (5, "a a " * 9, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    got = {(r["doc_id"], r["collapsed"], tuple(map(tuple, r["runs"]))) for r in periodic_runs(docs).collect()}
    assert got == {
        (1, "", ()), (2, "", ()), (3, "", ()), (None, "a", ((0, 6, 1),)), (4, "é z", ((0, 6, 1),)),
        (5, "a a", ((0, 9, 1),)),
    }
    assert periodic_runs(docs).count() == len(rows)
    assert periodic_runs(docs.limit(0)).collect() == []


def test_planted_runs(spark):
    import zlib

    texts = {i: " ".join(str((i * k) % 17) for k in range(i % 90)) for i in range(200)}
    texts[7] = None
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    changed = 0
    for row in with_planted_runs(docs).collect():
        h, words = zlib.crc32(str(row["doc_id"]).encode()), (texts[row["doc_id"]] or "").split()
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            wanted = " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
            assert row["text"] == wanted
            changed += 1
        else:
            assert row["text"] == texts[row["doc_id"]]
    assert changed > 5
