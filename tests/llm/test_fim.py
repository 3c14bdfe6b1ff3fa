"""Fill-in-the-middle against a plain version made with a list of tokens."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tripsense.llm import catalog, fim

SF = "/root/testdata/sf0.001"


def plain(id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if id is None else id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", text, None, None
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def texts(seed):
    rng = random.Random(seed)
    for _ in range(400):
        bits = [rng.choice(["a", "Bc", " ", "\n", "<", "P", ">", "<S", "é", "\U0001f600", "9", "z" * 20, "\r\n", "@[`{"]) for _ in range(rng.randint(0, 40))]
        yield "".join(bits)


def test_equals_plain_and_round_trip():
    for id, text in enumerate(texts(1)):
        made = fim.transformed(text, id)
        assert made == plain(id, text)
        assert fim.restored(made[2], made[1]) == text


@pytest.mark.parametrize("kind,unit", [
    (fim.RunContainer, "1" * 5000 + "ab" * 20), (fim.ArrayContainer, "a" * 900 + " "), (fim.BitmapContainer, "ab "),
])
def test_long_texts_over_several_containers(kind, unit):
    """Lengths around the container size, with tokens that go across its edge."""
    for length in (fim.CONTAINER - 1, fim.CONTAINER, fim.CONTAINER + 1, 3 * fim.CONTAINER + 77):
        text = (unit * (length // len(unit) + 1))[:length]
        held = fim.boundaries(text)
        assert any(isinstance(c, kind) for c in held.containers)
        starts = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)] + [length]
        assert len(held) == len(starts)
        picks = {0, 1, len(starts) - 1, *np.random.default_rng(1).integers(0, len(starts), 300).tolist()}
        assert all(held.select(k) == starts[k] for k in picks)


@pytest.mark.parametrize("kind", [fim.ArrayContainer, fim.BitmapContainer, fim.RunContainer])
def test_containers_select_every_value(kind):
    rng = np.random.default_rng(2)
    for values in (np.arange(fim.CONTAINER), np.array([0]), np.array([fim.CONTAINER - 1]), np.flatnonzero(rng.random(fim.CONTAINER) < 0.3)):
        held = kind(values)
        picks = np.unique(np.concatenate([[0, len(values) - 1], rng.integers(0, len(values), 200)]))
        assert [held.select(int(k)) for k in picks] == values[picks].tolist()


def test_query_over_the_whole_table(spark):
    wanted = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n, form, output, prefix, middle = plain(r["doc_id"], r["text"])
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in (output, r["text"] or "")]
        wanted[r["doc_id"]] = (n, form, prefix, middle, *sha)
    got = {r["doc_id"]: tuple(r)[1:] for r in catalog.op12_boundary_set(spark, SF).collect()}
    assert got == wanted and {w[1] for w in wanted.values()} == {"plain", "psm", "spm"}


def test_odd_rows(odd_documents, no_documents):
    assert fim.round_trip(fim.fill_in_middle(no_documents)).count() == 0
    rows = odd_documents.select("doc_id", "text").collect()
    made = fim.round_trip(fim.fill_in_middle(odd_documents)).collect()
    assert sorted(map(repr, ((r["id"], r["restored"]) for r in made))) == sorted(map(repr, ((r["doc_id"], r["text"] or "") for r in rows)))
    assert all(r["form"] == "plain" for r in made if not r["restored"])
