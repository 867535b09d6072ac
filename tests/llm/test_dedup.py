"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from tierline.llm.components import components
from tierline.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from tierline.llm.near_dedup import _short, common_at_most, drop_near_duplicates, near_duplicates


def key(row):
    return tuple((v is None, v) for v in row)


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    out = []
    for i, t, _ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=key)


def test_exact_against_brute_force(docs, rows, nothing):
    assert sorted(map(tuple, exact_duplicates(docs).collect()), key=key) == exact_by_hand(rows)
    assert exact_duplicates(nothing).count() == 0


def test_texts_whose_hashes_collide_stay_apart(docs, rows):
    weak = exact_duplicates(docs, lambda text: F.char_length(text) % 3)
    assert sorted(map(tuple, weak.collect()), key=key) == exact_by_hand(rows)


def test_dropping_exact_copies_keeps_all_columns(docs, rows, nothing):
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    by_hand = {(i, t or "") for i, t, _ in rows if i == max((x for x, y, _ in rows if (y or "") == (t or "") and x is not None), default=None)}
    assert {(r.doc_id, r.text or "") for r in left.collect()} == by_hand
    assert drop_exact_duplicates(nothing).count() == 0


def sets_of(rows):
    out = []
    for i, t, _ in rows:
        w = (t or "").encode().lower().split()
        out.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    return out


def near_by_hand(rows):
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        (i, x), (j, y) = sets[a], sets[b]
        if i is not None and j is not None and x and y:
            common = len(x & y)
            if 100 * common >= 75 * (len(x) + len(y) - common):
                parent[find(b)] = find(a)
    least = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return sorted(((i, len(s), c := None if i is None else least[find(n)], i is None or i == c) for n, (i, s) in enumerate(sets)), key=key)


def variants():
    """A text, copies with more and more words changed, and one that only links through another."""
    base = [f"w{k}" for k in range(200)]
    out = [(2000, " ".join(base), None)]
    for n in range(1, 12):
        changed = list(base)
        for k in range(n):
            changed[k * 16] = f"v{n}x{k}"
        out.append((2000 + n, " ".join(changed), None))
    for n in range(40):
        changed = base[: 120 + 2 * n]
        out.append((2100 + n, " ".join(changed), None))
    return out


def test_near_against_brute_force(spark, rows, docs, nothing):
    more = [*rows, *variants()]
    table = docs.unionByName(spark.createDataFrame(variants(), "doc_id bigint, text string, lang string"), allowMissingColumns=True)
    found = near_duplicates(table)
    assert sorted(map(tuple, found.collect()), key=key) == near_by_hand(more)
    assert near_duplicates(nothing).count() == 0


def test_dropping_near_copies_keeps_one_of_each_group(spark):
    table = spark.createDataFrame(variants(), "doc_id bigint, text string, kept string")
    left = {r.doc_id for r in drop_near_duplicates(table).collect()}
    assert left == {r[2] for r in near_by_hand(variants())}


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(1, 40)]
    star = [(100, k) for k in range(101, 140)]
    found = {r.node: r.root for r in components(spark.createDataFrame([*path, *star, (7, 7)], "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 140), 100)}


def test_cut_shingles_never_understate_what_is_common():
    rnd = np.random.default_rng(3)
    pool = rnd.integers(0, 2**63, 6000, dtype=np.uint64)
    sets = [np.unique(rnd.choice(pool, n)) for n in (1, 50, 400, 1500, 2600, 5000, 5000)]
    sizes = np.array([len(s) for s in sets])
    for chosen in (range(7), range(4), range(4, 7)):
        own = [sets[k] for k in chosen]
        bound = common_at_most([_short(s) for s in own], sizes[list(chosen)], np.arange(len(own)))
        for i, x in enumerate(own):
            for j, y in enumerate(own):
                assert i == j or bound[i, j] >= len(np.intersect1d(x, y))
