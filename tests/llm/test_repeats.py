"""Repeated strings against a count of all strings, and odd rows."""

import random

import pytest

from pdloom.llm import repeats
from pdloom.llm.repeats import Shape, anchors_of, intervals, remove_repeats, repeat_groups

LENGTH = 80


def brute(texts, length):
    """Per text the covered places, from the count of every string."""
    counts = {}
    for text in texts:
        for i in range(len(text) - length + 1):
            counts[text[i : i + length]] = counts.get(text[i : i + length], 0) + 1
    out = []
    for text in texts:
        covered = [False] * len(text)
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        out.append(covered)
    return out


def passages(seed, n=60, words=("", "a", "bc", "def", "\0", "é", "xyz")):
    """Texts of few words with shared passages, edits and periodic stretches."""
    rnd = random.Random(seed)

    def prose(size):
        return "".join(rnd.choice(words) + rnd.choice("qwertzuiopasdfghjkl") for _ in range(size))

    shared = [prose(rnd.randint(30, 200)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            kind = rnd.random()
            if kind < 0.4:
                parts.append(prose(rnd.randint(0, 60)))
            elif kind < 0.8:
                piece = rnd.choice(shared)
                a, b = sorted(rnd.randrange(len(piece) + 1) for _ in range(2))
                parts.append(piece if rnd.random() < 0.5 else piece[a:b])
            else:
                parts.append(rnd.choice(["=", "ab", "xyz-"]) * rnd.randint(1, 90))
        texts.append("".join(parts))
    return texts + texts[:4]


def rows_of(spark, texts):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept int, t string").repartition(3)


@pytest.mark.parametrize("seed, group, small", [(1, 4_096, False), (2, 4_096, True), (3, 2, False)])
def test_removes_what_a_count_of_all_strings_finds(spark, monkeypatch, seed, group, small):
    if small:
        monkeypatch.setattr(repeats, "SLICE", 64)
        monkeypatch.setattr(repeats, "STRINGS", 64)
        monkeypatch.setattr(repeats, "ROWS", 8)
    texts = passages(seed)
    data = [t.encode() for t in texts]
    wanted = brute(data, LENGTH)
    got = remove_repeats(rows_of(spark, texts), length=LENGTH, group=group).collect()
    assert len(got) == len(texts)
    some = 0
    for row in got:
        text, covered = data[row["doc_id"]], wanted[row["doc_id"]]
        assert row["n_bytes"] == len(text)
        held = [any(s["start"] <= i < s["end"] for s in row["spans"]) for i in range(len(text))]
        assert held == covered
        assert bytes(row["kept"]) == bytes(b for b, c in zip(text, covered) if not c)
        assert all(a["end"] < b["start"] for a, b in zip(row["spans"], row["spans"][1:]))
        some += bool(row["spans"]) and not all(covered)
    assert some > 5


def test_two_hundred_bytes_exactly(spark):
    rnd = random.Random(5)
    noise = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4_000))
    texts = [
        noise[:200] + noise[1000:1300], noise[1300:1600] + noise[:200], noise[2000:2199] + "1" + noise[2500:2700],
        "2" + noise[2000:2199] + "3" + noise[3000:3300],
    ]
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in remove_repeats(rows_of(spark, texts)).collect()}
    assert got == {0: [(0, 200)], 1: [(300, 500)], 2: [], 3: []}


@pytest.mark.parametrize("group", [4_096, 2])
def test_groups_cover_the_same_bytes_and_hold_equal_strings(spark, group):
    texts = passages(7, n=30)
    data = [t.encode() for t in texts]
    wanted = brute(data, LENGTH)
    groups = {}
    for r in repeat_groups(rows_of(spark, texts), length=LENGTH, group=group).collect():
        groups.setdefault(r["group_id"], set()).add((r["doc_id"], r["start"], r["n_bytes"]))
    covered = [[False] * len(t) for t in data]
    for members in groups.values():
        assert len(members) > 1
        assert len({data[d][s : s + n] for d, s, n in members}) == 1
        for d, s, n in members:
            assert n >= LENGTH
            covered[d][s : s + n] = [True] * n
    assert covered == wanted


def test_maximal_groups_have_all_occurrences(spark):
    rnd = random.Random(9)
    noise = ["".join(rnd.choice("abcdefghijklm ") for _ in range(300)) for _ in range(12)]
    core = noise[0][:90]
    texts = [noise[i + 1] + core + noise[i + 2][:40] for i in range(9)]
    found = repeat_groups(rows_of(spark, texts), length=LENGTH).where("n_bytes = 90").collect()
    by_group = {}
    for r in found:
        by_group.setdefault(r["group_id"], set()).add(r["doc_id"])
    assert by_group and all(len(v) == 9 for v in by_group.values())


def test_equal_strings_choose_one_anchor():
    rnd = random.Random(3)
    middle = bytes(rnd.choice(b"abcdef") for _ in range(500))
    left, right = (bytes(rnd.choice(b"abcdef") for _ in range(300)) for _ in range(2))
    found = anchors_of([left + middle, middle + right, b"short"], Shape(200))
    places = [set(found.place[found.text == i].tolist()) for i in range(2)]
    inside = {p - 300 for p in places[0] if 300 + 168 <= p <= 800 - 200}
    assert inside and inside <= places[1]
    assert not (found.text == 2).any()


def test_intervals():
    # banana: suffixes a, ana, anana, banana, na, nana with common prefixes 1, 3, 0, 0, 2
    assert list(intervals([0, 1, 3, 0, 0, 2])) == [(3, 1, 2), (1, 0, 2), (2, 4, 5)]
    assert list(intervals([])) == [] and list(intervals([0])) == []


def test_odd_rows(spark):
    line = "one line of text that says very little but is repeated again and again. " * 4
    rows = [
        (1, None, 0), (2, "", 0), (3, "short", 0), (4, "short", 0), (None, line, 0), (None, line, 0),
        (5, "x" * 201, 0), (6, "y" * 200, 0), (7, "z" * 3_000, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    got = [(r["doc_id"], len(r["kept"]), len(r["spans"])) for r in remove_repeats(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 0, 0), (2, 0, 0), (3, 5, 0), (4, 5, 0), (None, 0, 1), (None, 0, 1), (5, 0, 1), (6, 200, 0), (7, 0, 1)],
        key=str,
    )
    assert remove_repeats(docs.where("false")).collect() == []
    assert repeat_groups(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        remove_repeats(docs, length=10)
