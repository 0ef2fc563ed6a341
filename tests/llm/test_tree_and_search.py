"""The Merkle tree and the two searches over all rows, against brute force, with nulls, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import block_search, hard_negatives, merkle, tiles
from logloom.llm.common import groups
from tests.llm.test_operators import docs_of, rows_of


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels, place, digest):
    siblings = []
    for below in levels[:-1]:
        start = place // 3 * 3
        run = list(below[start : start + 3])
        siblings += run[: place - start] + run[place - start + 1 :]
        run[place - start] = digest
        digest, place = h(run), place // 3
    return siblings, digest


def brute_manifest(rows):
    def leaf(r, text):
        return h(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])

    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = [brute_tree([leaf(r, r.text) for r in sources[s]]) for s in names]
    top = brute_tree([t[-1][0] for t in trees])
    for k, s in enumerate(names):
        for place, r in enumerate(sources[s]):
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            low, digest = climb(trees[k], place, leaf(r, text))
            high, digest = climb(top, k, digest)
            yield r.doc_id, leaf(r, r.text), trees[k][-1][0], top[-1][0], h(low + high), digest, digest == top[-1][0]


@pytest.fixture(scope="module")
def leaves(spark):
    pick = random.Random(11)
    text = lambda k: [None, "", "a\nb", "größe\n\n" * (k % 5), "no break", "x" * 100_000 + "\n"][k % 6]
    rows = [(k, text(k), pick.choice([None, "a", "a", "a", "a", "b", "", "ü", "z"])) for k in range(400)]
    rows += [(7, "a\nb", "a"), (7, "a\nb", "a"), (7, "other", "a"), (None, "no id\n", "a"), (None, None, None), (-5, "minus\n", "only")]
    return docs_of(spark, rows)


def columns_of_op11(rows):
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof"), "version", F.col("version") == F.col("root")
    )


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, leaves, levels):
    changes = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    made = merkle.manifest(leaves, changes=changes, changed_where=F.crc32(F.col("doc_id").cast("string")) % 2 == 0, levels=levels)
    key = lambda r: tuple(str(x) for x in r)
    got = sorted((tuple(r) for r in columns_of_op11(made).collect()), key=key)
    assert got == sorted(brute_manifest(leaves.collect()), key=key)
    assert 0 < sum(r[-1] for r in got) < len(got)
    for r in rows_of(made.limit(50)):
        assert merkle.folded(r["leaf"], r["siblings"], r["turns"]) == r["root"]


def test_manifest_of_few_rows(spark, leaves):
    assert merkle.manifest(leaves.limit(0)).count() == 0
    one = rows_of(merkle.manifest(docs_of(spark, [(1, "t", "a")])))
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] == one[0]["version"] and one[0]["siblings"] == []
    same = rows_of(merkle.manifest(docs_of(spark, [(1, "t", "a")] * 5)))
    assert len(same) == 5 and len({r["pos"] for r in same}) == 5


def test_versions_share_untouched_nodes():
    base = merkle.block_levels([h([str(k)]) for k in range(27)], 27, 6)
    version = merkle.Version(base, 13, h(["new"]))
    assert len(version.copies) == len(base) == 4
    changed = [(level, k) for level in range(4) for k in range(len(base[level])) if version.node(level, k) is not base[level][k]]
    assert changed == [(0, 13), (1, 4), (2, 1), (3, 0)]
    assert version.top == brute_tree([version.node(0, k) for k in range(27)])[-1][0]


def test_groups_of_batches():
    import pyarrow as pa

    rows = pa.table({"a": [1, 1, 1, 2, 2, 3], "b": ["x", "x", "y", "y", "y", "y"]})
    for size in (1, 2, 6):
        got = [(g.column("a")[0].as_py(), g.column("b")[0].as_py(), g.num_rows) for g in groups(rows.to_batches(size), ["a", "b"])]
        assert got == [(1, "x", 2), (1, "y", 1), (2, "y", 2), (3, "y", 1)]
    assert list(groups([], ["a"])) == []


VECTORS = "vec_id long, embedding array<double>, label int, rank int, score double, slot string, name string, part int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, label, 3, 0.5, "s", "n", 1) for i, v, label in rows], VECTORS)


@pytest.fixture(scope="module")
def raw():
    pick = np.random.default_rng(12)
    rows = [(k, pick.normal(size=70).round(3).tolist(), int(pick.integers(0, 4))) for k in range(420)]
    # a hot vector, ties, near copies, unlike lengths, rows that take no part
    rows += [(1000 + k, rows[0][1], k % 2) for k in range(150)]
    rows += [(2000 + k, (np.array(rows[5][1]) + pick.normal(size=70) / 50).tolist(), 1) for k in range(60)]
    rows += [(3000 + 20 * k, pick.normal(size=5).tolist(), 2) for k in range(10)] + [(3300, [1e300] * 5, 2)]
    rows += [(40, None, 1), (60, [float("nan")] * 70, 1), (80, [None] * 70, 1), (100, [0.0] * 70, 1), (120, [], 1), (None, rows[3][1], 1), (140, rows[4][1], None)]
    return rows + [(1000, rows[0][1], 0), (1, rows[1][1], rows[1][2])]


def distinct_ids(rows):
    """The last row of every id."""
    seen, out = set(), []
    for r in reversed(rows):
        if r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def usable(v, zero=False):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


def plain_dot(x, y):
    total = 0.0  # sum() would compensate
    for a, b in zip(x, y):
        total += a * b
    return total


def test_nearest(spark, raw):
    some = [r for r in raw if r[0] != 3300]
    for rows in (some, distinct_ids(some)):
        found = vectors_of(spark, rows)
        got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows_of(block_search.nearest_rows(found, found.where(F.col("vec_id") % 20 == 0)))}
        whole = [(i, v) for i, v, _ in rows if i is not None and usable(v)]
        want = {}
        for i, v in sorted((i, v) for i, v in whole if i % 20 == 0)[::-1]:
            best = sorted((-plain_dot(v, x), j) for j, x in whole if j != i and len(x) == len(v))[:20]
            want |= {(i, k + 1): (j, -s) for k, (s, j) in enumerate(best)}
        assert got == want and len(want) > 400


def test_nearest_edges(spark, raw):
    none = vectors_of(spark, [])
    assert block_search.nearest_rows(none, none).count() == 0
    huge = vectors_of(spark, [r for r in raw if r[0] is not None and r[0] >= 3000])
    got = rows_of(block_search.nearest_rows(huge, huge.where("vec_id = 3300")))
    assert len(got) == 10


def test_bounds_hold():
    pick = np.random.default_rng(1)
    a = pick.normal(size=(50, 33)) * pick.lognormal(size=(50, 1)) * 100
    part = block_search.quantised(a, {"vec_id": np.arange(50)})
    lower, upper = block_search.bounds(part, part)
    assert (lower <= a @ a.T).all() and (a @ a.T <= upper).all()
    assert np.mean(upper - lower) < 0.1 * np.std(a @ a.T)
    whole = np.floor(a).astype(np.int64)
    for codes in (1, 4):
        part = hard_negatives.coded(whole, hard_negatives.rotation(33), codes)
        lower, upper = hard_negatives.intervals(part, np.arange(50), part, np.arange(50), 33)
        assert (lower <= whole @ whole.T).all() and (whole @ whole.T <= upper).all()
    assert np.mean(part["left"] / part["whole"]) < 0.3


def brute_negatives(rows):
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if i is not None and label is not None and usable(v, True)]
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    for i, label, v in rows:
        if i % 20:
            continue
        scored = [(-dot(v, x), j, other) for j, other, x in rows if j != i and len(x) == len(v)]
        for high, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fit = sorted(s for s in scored if s[2] != label and 80 * -high <= 100 * -s[0] <= 100 * -high)[:5]
            for rank, (score, j, _) in enumerate(fit, 1):
                yield i, positive, rank, j, -high, -score


def test_hard_negatives(spark, raw):
    rows = distinct_ids([r for r in raw if r[0] != 3300])
    for codes in (1, 4):
        got = sorted(tuple(r) for r in hard_negatives.mined(vectors_of(spark, rows), F.col("vec_id") % 20 == 0, codes=codes).collect())
        assert got == sorted(brute_negatives(rows)) and len(got) > 200
    none = vectors_of(spark, [])
    assert hard_negatives.mined(none, F.col("vec_id") % 20 == 0).count() == 0
    repeated = rows + [rows[20], rows[20]]
    assert hard_negatives.mined(vectors_of(spark, repeated), F.col("vec_id") == 0).count() > 0


def test_many_groups(spark, raw, monkeypatch):
    monkeypatch.setattr(tiles, "group_counts", lambda *_: (3, 5))
    rows = distinct_ids([r for r in raw if r[0] != 3300])
    got = sorted(tuple(r) for r in hard_negatives.mined(vectors_of(spark, rows), F.col("vec_id") % 20 == 0).collect())
    assert got == sorted(brute_negatives(rows))
    found = vectors_of(spark, rows)
    several = rows_of(block_search.nearest_rows(found, found.where(F.col("vec_id") % 20 == 0)))
    monkeypatch.undo()
    key = lambda r: (r["query_id"], r["rank"])
    assert sorted(several, key=key) == sorted(rows_of(block_search.nearest_rows(found, found.where(F.col("vec_id") % 20 == 0))), key=key)
