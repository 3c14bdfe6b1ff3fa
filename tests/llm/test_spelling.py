"""Spelling variants against a brute-force version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tripsense.llm import catalog, spelling

SF = "/root/testdata/sf0.001"


def plain_vocabulary(documents):
    counts = Counter()
    for id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def are_near(one, two):
    """Exactly one code point inserted, deleted or replaced."""
    if len(one) > len(two):
        one, two = two, one
    if one == two or len(two) - len(one) > 1:
        return False
    same = 0
    while same < len(one) and one[same] == two[same]:
        same += 1
    return one[same + (len(one) == len(two)) :] == two[same + 1 :]


def plain_variants(documents):
    """All pairs of words whose lengths allow it; words that share neither half of their letters cannot be near."""
    counts = plain_vocabulary(documents)
    near = {w: [] for w in counts}
    halves = {}
    for w in counts:
        for length in {len(w), len(w) + 1}:  # taken as the shorter or equal word of a pair
            half = length // 2
            halves.setdefault((length, "head", w[:half]), []).append(w)
            halves.setdefault((length, "tail", w[len(w) - (length - half - 1) :]), []).append(w)
        half = len(w) // 2
    found = set()
    for key, words in halves.items():
        for k, one in enumerate(words):
            for two in words[:k]:
                if are_near(one, two):
                    found.add((one, two) if one < two else (two, one))
    for one, two in found:
        near[one].append(two)
        near[two].append(one)
    return finished(counts, near)


def finished(counts, near):
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    rows = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return rows


def every_pair(documents):
    counts = plain_vocabulary(documents)
    words = sorted(counts)
    near = {w: [o for o in words if are_near(w, o)] for w in words}
    return finished(counts, near)


def rows_of(frame):
    return [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def made_texts(seed, rows, letters="abé", lengths=(6, 10), tokens=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(80)]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [(k if k % 7 else None, " ".join(rng.choices(words, weights, k=rng.randint(0, tokens)))) for k in range(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_every_pair(spark, seed):
    documents = made_texts(seed, 120)
    got = rows_of(spelling.variants(spark.createDataFrame(documents, "doc_id long, text string").repartition(4)))
    assert len(got) == len(set(got)) and set(got) == every_pair(documents)
    assert any(r[1] is not None for r in got) and any(r[4] > 1 for r in got)


def test_many_rounds_and_shards_give_the_same(spark):
    documents = made_texts(4, 150, letters="abcdéø")
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    got = rows_of(spelling.variants(frame, shard_words=7, round_words=20))
    assert len(got) == len(set(got)) and set(got) == every_pair(documents)
    plan = spelling.plan_rounds({7: 30, 8: 5, 9: 0}, 7, 20)
    assert len(plan) == 2 and [p[:3] for part in plan for p in part if p[0] == 7] == [(7, 5, k) for k in range(5)]


def test_query_over_the_whole_table(spark):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows_of(catalog.op11_bloom_neighbourhoods(spark, SF))
    assert len(got) == len(set(got)) and set(got) == plain_variants(documents)


def test_chains_end_at_their_last_form(spark):
    """Each word is ten times as frequent as the next, which is one letter away; the ends are four edits apart."""
    chain = ["planets", "plonets", "plongts", "plongis", "pxongis"]
    documents = [(1, " ".join(w for w, n in zip(chain, (20_000, 2_000, 200, 20, 2)) for _ in range(n)))]
    # One document: a run that is divisible loses a letter everywhere, so pick an id that leaves all of them alone.
    id = next(k for k in range(100) if all(zlib.crc32(f"{k}:{w}".encode()) % 31 for w in chain))
    rows = {r[0]: r for r in rows_of(spelling.variants(spark.createDataFrame([(id, documents[0][1])], "doc_id long, text string")))}
    assert [rows[w][1] for w in chain] == [None, *chain[:-1]] and {rows[w][2] for w in chain} == {"planets"}


def test_edits_of_batches_equal_single_ones():
    rng = random.Random(6)
    for length in (7, 8, 31):
        words = sorted({"".join(rng.choice("abzàÿ") for _ in range(length)) for _ in range(9)})
        points = spelling.code_points(words)
        row, place, code = spelling.deletions(points)
        made = [words[r][:p] + words[r][p + 1 :] for r, p in zip(row, place)]
        assert sorted(zip(row.tolist(), made)) == sorted({(k, w[:p] + w[p + 1 :]) for k, w in enumerate(words) for p in range(length)})
        assert (spelling.word_codes(spelling.code_points(made)) == code).all()
        row, place, letter, code = spelling.replacements(points, slice(2, length))
        made = [words[r][:p] + chr(spelling.ALPHABET[l]) + words[r][p + 1 :] for r, p, l in zip(row, place, letter)]
        assert (spelling.word_codes(spelling.code_points(made)) == code).all()
        wanted = {(k, w[:p] + chr(c) + w[p + 1 :]) for k, w in enumerate(words) for p in range(2, length) for c in spelling.ALPHABET if chr(c) > w[p]}
        assert set(zip(row.tolist(), made)) == wanted and len(made) == len(wanted)


def test_filters_lose_nothing_and_let_little_pass():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, 50_000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 50_000, dtype=np.uint64)
    held, others = codes[:25_000], codes[25_000:]
    filter_ = spelling.Filter.of(held, spelling.Filter.size(len(held)))
    assert len(filter_.hits(held)) == len(held) and len(filter_.hits(others)) < 0.005 * len(others)


def test_pieces_cut_no_run(monkeypatch):
    text = "Stück für Stück, " * 9 + "x" * 100 + " ende gut"
    whole = spelling.text_words(text, 5)
    monkeypatch.setattr(spelling, "PIECE_CHARS", 7)
    assert "".join(spelling._pieces(text)) == text and spelling.text_words(text, 5) == whole


def test_odd_rows(odd_documents, no_documents):
    assert rows_of(spelling.variants(no_documents)) == []
    documents = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    assert set(rows_of(spelling.variants(odd_documents))) == every_pair(documents)


def test_very_long_word(spark):
    """A run of thousands of letters, twice, and once more without one of them."""
    word = "ab" * 3_000
    rows = [(k, w) for k, w in enumerate([word, word, word[1:], word[1:]], 1) if True]
    rows = [(next(i for i in range(k * 100, k * 100 + 100) if zlib.crc32(f"{i}:{w}".encode()) % 31), w) for k, w in rows]
    got = {r[0]: r for r in rows_of(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got[word][4] == 1 and got[word[1:]][4] == 1
