from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tripsense.llm import simhash
from tripsense.llm.components import components


def plain_fingerprint(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(codes, limit=3):
    label = {c: c for c in codes}
    for a in codes:
        for b in codes:
            if (a ^ b).bit_count() <= limit and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {c: low if r == high else r for c, r in label.items()}
    return label


@pytest.mark.parametrize("text", [None, "", " \n", "One", "One TWO", "a b c", "A b c A b c A b c", "É É é x y z É", "w " * 5000])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 100)
    assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


def test_hash_is_that_of_the_engine(spark):
    engine = spark.sql("SELECT xxhash64('a b é') AS h").first()["h"] & (1 << 64) - 1
    assert engine == xxhash.xxh64_intdigest("a b é".encode(), 42)


@pytest.mark.parametrize("count", [1, 2, 8, 9, 65, 300])
def test_forest_joins_what_links_join(count):
    rng = np.random.default_rng(count)
    base = rng.integers(0, 2**63, size=max(1, count // 6), dtype=np.uint64)
    codes = base[rng.integers(0, len(base), count)]
    for _ in range(4):
        flips = (np.uint64(1) << rng.integers(0, 64, count).astype(np.uint64)) * (rng.random(count) < 0.5).astype(np.uint64)
        codes = codes ^ flips
    codes = np.unique(codes)
    rng.shuffle(codes)
    edges = list(zip(*(side.tolist() for side in simhash.forest(codes, 3))))
    label = {int(c): int(c) for c in codes}
    for a, b in edges:
        low, high = sorted((label[a], label[b]))
        label = {c: low if r == high else r for c, r in label.items()}
    assert label == plain_groups([int(c) for c in codes])
    assert len(edges) < len(codes)


@pytest.mark.parametrize("cell_rows", [simhash.CELL_ROWS, 3])
def test_groups_equal_brute_force(spark, cell_rows):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for group in range(12):
        own = rng.choice(words, 300).tolist()
        for copy in range(5):
            changed = own.copy()
            for at in rng.integers(0, 300, copy // 2):
                changed[at] = "other"
            texts.append(" ".join(changed))
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["id"]: r for r in simhash.near_duplicates(df, cell_rows=cell_rows).collect()}
    codes = {i: plain_fingerprint(t) for i, t in rows}
    label = plain_groups(set(codes.values()))
    assert {i: r["code"] & (1 << 64) - 1 for i, r in got.items()} == codes
    expected = {i: min(j for j in codes if label[codes[j]] == label[codes[i]]) for i in codes}
    assert {i: r["component_id"] for i, r in got.items()} == expected
    assert len(set(expected.values())) < len(rows)
    kept = {r["doc_id"] for r in simhash.keep_one(df).collect()}
    assert kept == set(expected.values())


def test_a_chain_and_a_star_are_one_component_each(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(chain + star + [(5, 5), (None, 3)], "a long, b long").repartition(5)
    roots = {r["node"]: r["root"] for r in components(df).collect()}
    assert roots == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
    assert components(df.limit(0)).count() == 0


def test_odd_rows(odd_documents, no_documents):
    got = simhash.near_duplicates(odd_documents)
    assert got.count() == odd_documents.count()
    assert {r["id"] for r in got.filter("code = 0").collect()} == {1, 2, 3, None}
    assert {r["component_id"] for r in got.filter("code = 0").collect()} == {1}
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, None, 4, 6, 7, 8], key=str)
    assert kept.filter(F.col("_id") != "extra").count() == 0
    assert simhash.near_duplicates(no_documents).count() == simhash.keep_one(no_documents).count() == 0
