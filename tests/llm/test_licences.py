"""Licence scans against word lists and expressions evaluated by hand."""

from __future__ import annotations

import random
import re

import pytest

from tripsense.llm import catalog, licences

SF = "/root/testdata/sf0.001"
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_places(words, phrases):
    return sorted((k, label) for phrase, label in phrases.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())


def test_equals_plain_places():
    rng = random.Random(5)
    bits = [*"gnu general public license apache cc by mit nc sa the é ü 42".split(" "), "GNU General\nPublic-License", "lesser", "MIT License", "CC BY"]
    for _ in range(300):
        text = "".join(rng.choice(bits) + rng.choice([" ", " ", "\n", ", ", "_", "\x00", "-"]) for _ in range(rng.randint(0, 30)))
        words = plain_words(text)
        found = licences.scan_text(text)
        assert found.n_words == len(words) and found.base == plain_places(words, BASE)
        assert found.labels == {label for _, label in plain_places(words, {**licences.PHRASES, **BASE})} | {
            label for phrase, label in licences.PHRASES.items() if plain_places(words, {phrase: label})
        }


@pytest.mark.parametrize("text,postfix,score,in_force", [
    ("MIT", "MIT", 0.95, {"mit"}),
    ("MIT OR GPL-2.0-only", "MIT GPL-2.0-only or", 0.95, {"mit"}),
    ("MIT AND GPL-2.0-only", "MIT GPL-2.0-only and", 0.3, {"mit", "gpl"}),
    ("GPL-3.0 WITH Classpath-exception-2.0", "GPL-3.0 Classpath-exception-2.0 with", 0.65, {"gpl"}),
    ("MIT or Apache-2.0 and GPL-2.0+ with Autoconf-exception", "MIT Apache-2.0 GPL-2.0+ Autoconf-exception with and or", 0.95, {"mit"}),
    ("(MIT or Apache-2.0) and LGPL-2.1", "MIT Apache-2.0 or LGPL-2.1 and", 0.5, {"mit", "lgpl"}),
    ("((CC-BY-NC-4.0)) OR odd-1.0", "CC-BY-NC-4.0 odd-1.0 or", 0.25, {"odd-1.0"}),
    ("BSD-3-Clause OR", "BSD-3-Clause", 0.95, {"bsd"}),
    ("BSD-3-Clause AND (ISC OR", "BSD-3-Clause ISC and", 0.95, {"bsd", "isc"}),
    ("MIT and more words */", "MIT more and", 0.25, {"mit", "more"}),
    ("MIT) or GPL", "MIT", 0.95, {"mit"}),
    ("(((", "", None, None), ("", "", None, None), ("or MIT", "", None, None), ("*/", "", None, None),
])
def test_expressions(text, postfix, score, in_force):
    tokens, length = licences.postfix(text)
    assert length <= len(text)
    assert " ".join(tokens) == postfix
    terms = licences.evaluate(tokens)
    assert (terms is None) == (score is None)
    if terms:
        assert terms.score == pytest.approx(score) and terms.labels == in_force
    tagged = licences.scan_text(f"é // SPDX-License-Identifier: {text}\nMIT is not a phrase")
    assert tagged.expressions == ([postfix] if postfix else []) and tagged.score == pytest.approx(score or 0.0)
    assert tagged.in_force == (in_force or set())


def plain_value(tree):
    """Score and labels of an expression given as a tree."""
    if isinstance(tree, str):
        label = licences.label_of(tree)
        return licences.PERMISSION.get(label, licences.UNKNOWN_PERMISSION), {label}
    operator, left, right = tree
    a = plain_value(left)
    if operator == "with":
        return (a[0] + 1) / 2, a[1]
    b = plain_value(right)
    return (a if a[0] >= b[0] else b) if operator == "or" else (min(a[0], b[0]), a[1] | b[1])


def test_random_expressions_equal_their_trees():
    rng = random.Random(8)

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(["MIT", "GPL-2.0", "Apache-2.0", "CC-BY-SA-4.0", "MPL-2.0", "Odd"])
        operator = rng.choice(["and", "or", "with"])
        return operator, tree(depth - 1), "Some-exception" if operator == "with" else tree(depth - 1)

    def written(node):
        return node if isinstance(node, str) else f"({written(node[1])}) {node[0].upper()} ({written(node[2])})"

    def named(node):
        return [node] if isinstance(node, str) else named(node[1]) + ([] if node[0] == "with" else named(node[2]))

    for _ in range(300):
        made = tree(5)
        tokens, length = licences.postfix(written(made))
        assert length == len(written(made))
        terms, (score, labels) = licences.evaluate(tokens), plain_value(made)
        assert terms.score == pytest.approx(score) and terms.labels == labels
        assert sorted(licences.identifiers(tokens)) == sorted(named(made))


def test_long_and_deep_texts_take_linear_time():
    text = "MIT License, " * 60_000 + "SPDX-License-Identifier: " + "(MIT OR " * 20_000 + "GPL-2.0" + ")" * 20_000
    found = licences.scan_text(text)
    assert len(found.base) == 60_000 and found.labels == {"mit", "gpl"} and len(found.expressions) == 1


def test_query_over_the_whole_table(spark):
    rows = {r["doc_id"]: r for r in catalog.op13_licence_automaton(spark, SF).collect()}
    hits = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words, got = plain_words(r["text"]), rows.pop(r["doc_id"])
        places = plain_places(words, BASE)
        hits += bool(places)
        names = {label for _, label in places}
        assert (got["n_words"], got["n_base"], got["base_labels"]) == (len(words), len(places), ",".join(sorted(names)))
        assert (got["first_word"], got["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert names <= set(filter(None, got["labels"].split(","))) and 0 <= got["score"] <= 1
    assert not rows and hits


def test_odd_rows(odd_documents, no_documents):
    assert licences.scan(no_documents).count() == 0
    got = licences.scan(odd_documents).collect()
    assert len(got) == odd_documents.count() and all(r["score"] == 0 and not r["labels"] for r in got)
