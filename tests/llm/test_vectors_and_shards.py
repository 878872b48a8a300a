"""Sharding, hard negatives and vector codes against brute force, with nulls, ties, repeats, no rows and clashing columns."""

import hashlib
import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starload.llm import hard_negatives as hard
from starload.llm import intvec, sharding, vector_codes

VECTORS = "vec_id long, embedding array<double>, label int, vec string, dims int, chunk int, side int, codes int, row int, part int"


def table(spark, rows):
    """(vec_id, embedding, label) and columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 1, 1, 1, 1, 1) for r in rows], VECTORS)


# ---- op11 ------------------------------------------------------------------------------------------

def shards(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.shard].append(r)
    for rows_ in out.values():
        assert sorted(r.slot for r in rows_) == list(range(len(rows_)))
    return out


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 7, 8, 9) for i, t in rows], "doc_id long, text string, size long, shard int, slot int")


def test_shards_are_near_equal_and_gapless(llm):
    rng = np.random.default_rng(1)
    rows = [(i, "é" * int(rng.integers(0, 60))) for i in range(3000)] + [(None, None), (None, ""), (None, "x"), (5, "x")]
    rows += [(k, "one hot text " * 3) for k in range(5000, 6500)]  # a third of all rows in one group
    rows += [(9, "same row " * 4)] * 1500  # and a third of them alike in all columns
    docs = documents(llm, rows).repartition(7)
    got = sharding.assign(docs).collect()
    assert Counter((r.row.doc_id, r.row.text, r.row.slot) for r in got) == Counter((i, t, 9) for i, t in rows)
    for r in got:
        raw = (r.row.text or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    sizes = [sum(r["size"] for r in rows_) for rows_ in shards(got).values()]
    mean = sum(sizes) / 16
    assert len(sizes) == 16 and max(abs(s - mean) for s in sizes) <= 0.1 * mean
    split = {t for t, n in Counter(t for t, _ in {(r.row.text, r.shard) for r in got}).items() if n > 1}
    assert {"one hot text " * 3, "same row " * 4} <= split and len(split) <= 10
    again = sharding.assign(documents(llm, rows).repartition(3), carry=["doc_id", "text"]).collect()
    place = lambda rows_: sorted((str(r.row.doc_id), str(r.row.text), r.shard, r.slot) for r in rows_)
    assert place(again) == place(got)  # whatever the input's partitions


def test_shards_of_few_huge_and_no_rows(llm):
    for rows in ([], [(1, "a")], [(1, "a"), (2, None)], [(1, "a" * 100_000), (2, "b"), (3, "c"), (4, "b" * 70_000)]):
        got = sharding.assign(documents(llm, rows)).collect()
        assert Counter(r.row.doc_id for r in got) == Counter(i for i, _ in rows)
        assert all(0 <= s < 16 for s in shards(got))


def test_an_overfull_range_is_divided(llm, monkeypatch):
    """With a sample too small to see a range's weight, exact sums find it and a second sample divides it."""
    monkeypatch.setattr(sharding, "SAMPLES", 1)
    rows = sharding.keyed(documents(llm, [(i, f"text {i % 700} " * 5) for i in range(4000)]), ["doc_id"])
    bounds, sums = sharding.ranges(rows, 4)
    total = sum(b for b, _ in sums.values())
    assert len(bounds) > 100 and max(b for b, _ in sums.values()) <= 2.5 * total / (4 * sharding.RANGES)
    assert sum(n for _, n in sums.values()) == 4000


def test_range_search_counts_boundaries(llm):
    bounds = sorted({(int(a), int(b), 0) for a, b in np.random.default_rng(2).integers(-50, 50, (1500, 2))})
    rows = llm.range(-60, 60).select(F.col("id").alias("text_hash"), F.lit(0).cast("long").alias("id_hash"), F.lit(0).cast("long").alias("row_hash"))
    for some in ([], bounds[:1], bounds[:32], bounds[:33], bounds):
        got = {r.text_hash: r.n for r in rows.withColumn("n", sharding.range_of(some)).collect()}
        assert got == {t: sum(b <= (t, 0, 0) for b in some) for t in range(-60, 60)}


def test_written_shards_hold_their_rows(llm, tmp_path):
    rows = [(i, f"text {i}") for i in range(100)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    placed = sharding.assign(docs, 4)
    sharding.write_shards(placed, str(tmp_path / "shards"))
    back = llm.read.parquet(str(tmp_path / "shards")).collect()
    assert {(r.doc_id, r.text, r.shard, r.slot) for r in back} == {(r.row.doc_id, r.row.text, r.shard, r.slot) for r in placed.collect()}


# ---- op12 ------------------------------------------------------------------------------------------

def negatives_by_force(rows, k=5, m=5, least=80):
    out = []
    rows = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and lab is not None and v]
    for i, v, lab in rows:
        if i % 100:
            continue
        near = sorted((-int(w @ v), j, other) for j, w, other in rows if j != i and len(w) == len(v))
        for p, pid, _ in [x for x in near if x[2] == lab][:k]:
            band = [(s, j) for s, j, other in near if other != lab and least * -p <= 100 * -s <= 100 * -p][:m]
            out += [(i, pid, rank + 1, j, -p, -s) for rank, (s, j) in enumerate(band)]
    return sorted(out)


def test_lookups_equal_inner_products():
    rng = np.random.default_rng(3)
    for dims, largest in ((1, 1), (7, 100), (8, 5), (20, 40_000), (64, 300)):
        a, c = (rng.integers(-largest, largest + 1, (n, dims)) for n in (5, 40))
        bits = hard.pack_bits(c, int(largest).bit_length() + 1)
        assert (hard.unpack_bits(bits)[:, :dims] == c).all()
        wide = np.zeros((5, -(-dims // 8) * 8), dtype=np.int64)
        wide[:, :dims] = a
        assert (hard.scores(hard.subset_sums(wide), bits) == c @ a.T).all()


@pytest.mark.parametrize("tile", [7, 8192])
def test_hard_negatives_match_brute_force(llm, monkeypatch, tile):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(6, 10))
    rows = [(i, [float(x) for x in centre[i % 6] + rng.normal(size=10) * 0.8], int(rng.integers(3))) for i in range(900)]
    rows[200] = (200, rows[100][1], rows[100][2])  # equal rows
    rows += [(i, rows[100][1], i % 3) for i in range(900, 940)]  # many ties
    rows += [(940, None, 1), (941, [None] * 10, 1), (942, [float("nan")] * 10, 1), (943, [], 1), (None, rows[0][1], 1), (944, rows[0][1], None),
             (1000, [1.0, 2.0], 1), (1001, [2.0, 1.0], 1), (1002, [1.0, 1.9], 2), (700, rows[700][1], rows[700][2]), (3, rows[3][1], rows[3][2])]
    monkeypatch.setattr(hard, "TILE", tile)
    monkeypatch.setattr(hard, "ANCHORS", 3)
    vectors = intvec.integer_rows(table(llm, rows), 256)
    got = sorted(tuple(r) for r in hard.mine(vectors, F.col("vec_id") % 100 == 0).collect())
    want = negatives_by_force([(r.vec_id, r.vec, r.label) for r in vectors.collect()])
    assert got == want and len(got) > 50


def test_hard_negatives_of_hot_labels_and_no_rows(llm):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4)], 0 if i % 3 else 1 + i % 40) for i in range(1200)]
    vectors = intvec.integer_rows(table(llm, rows), 16)
    got = sorted(tuple(r) for r in hard.mine(vectors, F.col("vec_id") % 100 == 0).collect())
    assert got == negatives_by_force([(r.vec_id, r.vec, r.label) for r in vectors.collect()])
    assert hard.mine(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert hard.mine(vectors.where("label = 0"), F.col("vec_id") % 100 == 0).count() == 0
    assert hard.mine(vectors, F.col("vec_id") < 0).count() == 0
    with pytest.raises(ValueError):
        hard.mine(intvec.integer_rows(table(llm, [(0, [1e13], 1)]), 256), F.col("vec_id") == 0)
    with pytest.raises(PySparkException, match="beyond"):
        intvec.integer_rows(table(llm, [(0, [1e300], 1)]), 256).collect()


# ---- op13 ------------------------------------------------------------------------------------------

def codes_by_force(rows, parts, entries, rounds):
    width = -(-max(len(v) for _, v, _ in rows) // parts)
    v = np.array([list(x) + [0] * (parts * width - len(x)) for _, x, _ in rows], dtype=np.int64).reshape(len(rows), parts, width)
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))[:entries]
    books = v[first].transpose(1, 0, 2).copy()

    def nearest():
        d = np.square(v.transpose(1, 0, 2)[:, :, None] - books[:, None]).sum(axis=3)
        return d.argmin(axis=2).T, d.min(axis=2).T

    for _ in range(rounds):
        codes, _ = nearest()
        for p in range(parts):
            for e in set(codes[:, p].tolist()):
                books[p, e] = v[codes[:, p] == e, p].sum(axis=0) // (codes[:, p] == e).sum()
    codes, dist = nearest()
    return [(r[0], r[2], tuple(c.tolist()), int(d.sum())) for r, c, d in zip(rows, codes, dist)], books


def test_walsh_hadamard_keeps_distances():
    rng = np.random.default_rng(6)
    for width in (1, 2, 3, 8, 13, 16):
        a, b = rng.integers(-1000, 1000, (2, 20, width))
        x, y = vector_codes.walsh(a), vector_codes.walsh(b)
        assert (np.square(x - y).sum(axis=1) == x.shape[1] * np.square(a - b).sum(axis=1)).all()
        changes = (np.diff(np.sign(vector_codes.walsh(np.eye(x.shape[1], dtype=np.int64)).T), axis=1) != 0).sum(axis=1)
        assert changes.tolist() == list(range(x.shape[1]))


@pytest.mark.parametrize("width,entries", [(16, 32), (10, 8), (3, 4), (64, 256)])
def test_codes_match_brute_force(llm, width, entries):
    rng = np.random.default_rng(width)
    rows = [(i, [float(x) for x in rng.normal(size=width) * 0.1], [0, 1, None][i % 3]) for i in range(400)]
    rows += [(400, rows[0][1], 1), (401, rows[0][1][:-1], 1), (402, None, 1), (403, [None] * width, 1), (404, [float("inf")] * width, 1),
             (None, rows[5][1], None), (7, rows[9][1], 0), (405, [], 2)]
    vectors = intvec.integer_rows(table(llm, rows), 1024)
    want, books = codes_by_force([(r.vec_id, r.vec, r.label) for r in vectors.collect()], 4, entries, 4)
    codes, got = vector_codes.compress(vectors, 4, entries, 4)
    out = vector_codes.with_label_error(codes).collect()
    assert (got.books == books).all()
    assert sorted(((r.vec_id, r.label, tuple(r.codes), r.error) for r in out), key=str) == sorted(want, key=str)
    sums = Counter()
    for r in out:
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] for r in out)
    assert got.sha256() == hashlib.sha256(",".join(json.dumps(books.tolist()).replace("[", "").replace("]", "").split(", ")).encode()).hexdigest()
    one = np.array([out[0].codes])
    assert got.decode(one).shape == (1, got.width)


def test_codes_of_few_equal_and_no_rows(llm):
    vectors = intvec.integer_rows(table(llm, [(i, [0.5, -0.5, 0.25, 0.0], 1) for i in (3, 1, 2)]), 1024)
    codes, books = vector_codes.compress(vectors)
    assert [(tuple(r.codes), r.error) for r in codes.collect()] == [((0, 0, 0, 0), 0)] * 3 and books.books.shape == (4, 3, 1)
    codes, books = vector_codes.compress(vectors.limit(0))
    assert books is None and vector_codes.with_label_error(codes).count() == 0
    with pytest.raises(ValueError):
        vector_codes.fit(intvec.integer_rows(table(llm, [(0, [1e12], 1)]), 1024))
