"""Vector codes against a plain Lloyd iteration in Python integers, and odd rows."""

import hashlib
import math

import numpy as np
import pytest

from pdloom.llm import vector_codes
from pdloom.llm.vector_codes import build_tree, compress_vectors, nearest_entries

SCHEMA = "vec_id bigint, vector array<double>, label int, code string, error int"


def plain(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and digest of (id, vector, label) rows of one length."""
    rows = sorted(rows, key=lambda r: r[0])
    ints = [[math.floor(4096 * x) for x in r[1]] for r in rows]
    width = len(ints[0]) // parts
    pieces = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in ints]
    books = [[pieces[i][p] for i in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(piece, book):
        far = [sum((x - y) ** 2 for x, y in zip(piece, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in pieces:
                groups.setdefault(nearest(v[p], books[p])[0], []).append(v[p])
            for e, held in groups.items():
                books[p][e] = [sum(c) // len(held) for c in zip(*held)]
    out = {}
    for r, v in zip(rows, pieces):
        found = [nearest(v[p], books[p]) for p in range(parts)]
        out[r[0]] = ("".join(f"{c:02x}" for c, _ in found), sum(e for _, e in found))
    numbers = [str(x) for b in books for e in b for x in e]
    return out, hashlib.sha256(",".join(numbers).encode()).hexdigest()


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    found, books = compress_vectors(df)
    got = found.collect()
    wanted, digest = plain(rows)
    assert len(got) == len(rows) and books.sha256() == digest
    by_label = {}
    for r in rows:
        by_label[r[2]] = by_label.get(r[2], 0) + wanted[r[0]][1]
    for r in got:
        assert (r["code"], r["error"]) == wanted[r["vec_id"]]
        assert r["label_error"] == by_label[r["label"]]


@pytest.mark.parametrize("block, leaf", [(2_048, 16), (50, 1)])
def test_equals_plain_lloyd(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    random = np.random.default_rng(1)
    centres = random.normal(0, 1, (9, 24))
    rows = [
        (i, (centres[i % 9] + random.normal(0, 0.05, 24)).tolist(), None if i % 7 == 0 else i % 3)
        for i in range(400)
    ]
    check(spark, rows)


def test_ties_and_repeats(spark):
    random = np.random.default_rng(2)
    rows = [(i, (random.integers(0, 2, 16) / 4096).tolist(), 0) for i in range(300)]
    check(spark, rows)
    check(spark, [(i, [0.5] * 16, 0) for i in range(40)])


def test_large_components_stay_exact(spark):
    random = np.random.default_rng(3)
    rows = [(i, (random.normal(0, 2.0**16, 16)).tolist(), 0) for i in range(60)]
    check(spark, rows)


def test_whole_nodes_are_assigned_by_their_sums():
    random = np.random.default_rng(4)
    rows = np.concatenate([random.integers(0, 9, (500, 3)), random.integers(1000, 1009, (500, 3))])
    entries = np.array([[1004, 1004, 1004], [4, 4, 4], [4, 4, 4]])
    chosen, counts, sums = nearest_entries(rows, build_tree(rows, 16), entries, build_tree(entries, 1))
    assert chosen.tolist() == [1] * 500 + [0] * 500
    assert counts.tolist() == [500, 500, 0] and (sums[1] == rows[:500].sum(axis=0)).all()


def test_odd_rows(spark):
    good = [(i, [i / 7, -i / 3] * 8, 1) for i in range(5)]
    bad = [
        (10, None, 1), (11, [None, 1.0] * 8, 1), (12, [float("nan")] * 16, 1), (13, [float("inf")] * 16, 1),
        (14, [1.0], 1), (15, [1e300] * 16, 1), (16, [], 1),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in good + bad + [(None, [0.1] * 16, None)]], SCHEMA)
    found, _ = compress_vectors(df)
    assert sorted(str(r["vec_id"]) for r in found.collect()) == ["0", "1", "2", "3", "4", "None"]
    found, books = compress_vectors(df.where("false"))
    assert found.collect() == [] and books.sha256() == hashlib.sha256(b"").hexdigest()
    found, _ = compress_vectors(df.where("vec_id = 16"))
    assert [(r["code"], r["error"]) for r in found.collect()] == [("00" * 8, 0)]
    narrow = spark.createDataFrame([(i, [float(i)] * 3, 0, "x", 1) for i in range(20)], SCHEMA)
    assert compress_vectors(narrow)[0].count() == 20
    far = spark.createDataFrame([(i, [i * 2.0**45] * 8, 0, "x", 1) for i in range(40)], SCHEMA)
    assert compress_vectors(far)[0].where("error is null").count() > 0


@pytest.mark.parametrize("labels", [3, 2_500])
def test_label_errors(spark, labels):
    df = spark.range(8_000).selectExpr(
        "if(id % 3 = 0, 0, if(id % 3 = 1, null, id % " + str(labels) + ")) as label", "id as error"
    )
    got = {r["label"]: r["label_error"] for r in vector_codes.label_errors(df).distinct().collect()}
    wanted = {r["label"]: r["s"] for r in df.groupBy("label").agg({"error": "sum"}).toDF("label", "s").collect()}
    assert got == wanted
    assert vector_codes.label_errors(df).count() == 8_000
