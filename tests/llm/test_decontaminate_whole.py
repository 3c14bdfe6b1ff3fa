"""Every place that holds an item is found, however large the benchmark, short the item or common the copy."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tripsense.llm import decontaminate


def test_short_items_of_a_large_benchmark_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"word{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)] + rng.choices(["the", "of", "and"], k=n // 3)
    items = []
    for i in range(3000):
        said = text(rng.randint(7, 12))[: rng.randint(8, 12)]
        rng.shuffle(said)
        items.append((i, said))
    rows, planted = [], set()
    for i in range(120):
        said = text(rng.randint(100, 400))
        rng.shuffle(said)
        if i % 4:
            number, at = rng.randrange(len(items)), rng.randint(0, len(said))
            copy = items[number][1].copy()
            if i % 4 == 1:
                copy[rng.randrange(len(copy))] = "else"
            said[at:at] = copy
            planted.add((i, number))
        rows.append((i, said))
    documents = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r["id"], r["item_id"]) for r in decontaminate.contaminated(documents, benchmark).collect()}
    shares = every_start(rows, items)
    plain = {key for key, (share, answered) in shares.items() if share >= 0.7 or share >= 0.5 and answered}
    copies = {key for key, (share, _) in shares.items() if share >= 0.7}
    assert planted <= copies <= got <= plain


def every_start(rows, items):
    """Best share and whether the answer is there, for every document and item, from spans at every word."""
    block = decontaminate.Block([{"id": i, "text": " ".join(w), "answer": None} for i, w in items])
    out = {}
    for d, said in rows:
        at = np.array([k for k, w in enumerate(said) if w in block.vocabulary], dtype=np.int64)
        words = np.array([block.vocabulary[said[k]] for k in at], dtype=np.int64)
        for item in block.items:
            held = item.of_item(words)
            if held.sum() < 0.5 * len(item.words):
                continue
            places, own, best = at[held], words[held], (0.0, False)
            ends = np.searchsorted(places, places + item.span)
            for low in np.flatnonzero(ends - np.arange(len(places)) >= 0.5 * len(item.words)).tolist():
                part = own[low : ends[low]].tolist()
                share = item.common(part) / len(item.words)
                if share > best[0]:
                    found = Counter(part)
                    best = share, sum(min(n, found[w]) for w, n in item.answer.items()) >= 0.5 * item.answer.total()
            if best[0] >= 0.5:
                out[d, item.id] = best
    return out


def test_paraphrases_come_from_the_cosine(spark):
    """Half of an item's words in order, among others: the cosine finds them, the index of copies need not."""
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(1500)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)] + rng.choices(["the", "of", "and", "in"], k=n // 3)
    items = []
    for i in range(60):
        said = text(rng.randint(20, 45))
        rng.shuffle(said)
        items.append((i, said))
    rows, planted = [], {}
    for i in range(240):
        said = text(rng.randint(60, 300))
        rng.shuffle(said)
        if i % 2:
            number, at = rng.randrange(len(items)), rng.randint(0, len(said))
            words = items[number][1]
            share = rng.uniform(0.4, 0.5)
            copy = [w if rng.random() < share or k >= len(words) - 5 else rng.choice(vocabulary) for k, w in enumerate(words)]
            said[at:at] = copy
            planted[i] = number
        rows.append((i, said))
    documents = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    shares = every_start(rows, items)
    wanted = {key for key, (share, answered) in shares.items() if 0.5 <= share < 0.7 and answered}
    plain = wanted | {key for key, (share, _) in shares.items() if share >= 0.7}
    found = {limit: {(r["id"], r["item_id"]) for r in decontaminate.contaminated(documents, benchmark, least_cosine=limit).collect()} for limit in (decontaminate.LEAST_COSINE, 2.0)}
    on, off = found[decontaminate.LEAST_COSINE], found[2.0]
    assert len(wanted) > 40 and on <= plain and len(on & wanted) >= 0.9 * len(wanted)
    assert off < on and len(wanted - off) >= 10


def test_short_items_are_phrases(spark):
    items = [(1, "one two three four"), (2, "five six seven eight nine ten eleven"), (3, "too short here"), (4, None), (5, "")]
    rows = [
        (1, "say One, two three FOUR now"), (2, "one two and three four"), (3, "five six seven eight nine ten eleven"),
        (4, "five six seven eight nine ten and eleven"), (5, "too short here"), (6, "four three two one one two three four"),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contaminated(documents, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["id"], r["item_id"], r["share"], r["cosine"], r["start_word"]) for r in got} == {(1, 1, 1.0, None, 1), (3, 2, 1.0, None, 0), (6, 1, 1.0, None, 4)}


def test_blocks_do_not_matter(spark):
    """A long text against a benchmark in one block and in several."""
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(4, 90)))) for i in range(30)]
    long_text = " ".join(f"{' '.join(rng.choice(vocabulary) for _ in range(900))} {items[k % 30][1]}" for k in range(60))
    documents = spark.createDataFrame([(1, long_text), (2, items[3][1])], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def found(**options):
        rows = decontaminate.contaminated(documents, benchmark, **options).collect()
        return {(r["id"], r["item_id"], r["share"], r["start_word"]) for r in rows}

    whole = found()
    assert {i for d, i, share, _ in whole if d == 1 and share == 1} == set(range(30))
    assert {(d, i, s, at) for d, i, s, at in found(block_words=300) if s == 1} == {(d, i, s, at) for d, i, s, at in whole if s == 1}


def test_runs_cut_no_row(monkeypatch):
    monkeypatch.setattr(decontaminate, "WORDS_AT_ONCE", 4)
    rows = np.repeat(np.arange(5), [3, 1, 9, 2, 4])
    runs = list(decontaminate._runs(rows))
    assert [r.start for r in runs] == [0, *[r.stop for r in runs[:-1]]] and runs[-1].stop == len(rows)
    assert all(rows[r.start - 1] != rows[r.start] for r in runs[1:])


def copies_among(others, copies):
    rng = random.Random(6)
    item = "what is the tallest hill of the northern island called in old songs"
    rows = [(i, " ".join(f"w{rng.randint(0, 500)}" for _ in range(15))) for i in range(others)]
    return item, rows + [(1000 + i, item) for i in range(copies)]


@pytest.mark.parametrize("others, copies", [(60, 30), (0, 2), (0, 1), (200, 1)])
def test_frequent_copies_are_found(spark, others, copies):
    item, rows = copies_among(others, copies)
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = decontaminate.contaminated(documents, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert {r["id"] for r in got} == {1000 + i for i in range(copies)} and len(got) == copies
    assert all(r["share"] == 1 and r["cosine"] > decontaminate.LEAST_COSINE for r in got)
