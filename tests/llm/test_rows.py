"""Chat, page extraction, mixing, sharding, reputation and the pipeline."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripsense.llm import boosting, catalog, chat, html, mixing, reputation, ring


# chat


def plain_messages(events):
    """Conversations replayed in the order of turns, then of sequence numbers."""
    out = []
    by_conversation = defaultdict(lambda: defaultdict(list))
    for conv, turn, seq, kind, role, text in events:
        by_conversation[conv][turn].append((seq, role, text, kind))
    for conv, turns in by_conversation.items():
        undone = -1
        for turn in sorted(turns):
            latest, said = -1, []
            for seq, role, text, kind in sorted(turns[turn]):
                if seq < undone:
                    continue
                if kind == "message" or not said:
                    said.append([conv, turn, role, text])
                elif kind == "delta":
                    said[-1][3] += text
                else:
                    said[-1][3] = text
                    if kind == "regenerate":
                        latest = max(latest, seq)
            out += said
            undone = max(undone, latest)
    return sorted(map(tuple, out))


def test_folding_equals_a_replay(spark):
    rng = random.Random(3)
    events, kinds = [], ["message", "delta", "delta", "edit", "regenerate"]
    for conv in range(30):
        for seq in range(rng.randint(1, 40)):
            events.append((conv, rng.randint(0, 6), seq, rng.choice(kinds), rng.choice(["user", "assistant"]), rng.choice("abc") * rng.randint(0, 3)))
    rng.shuffle(events)
    schema = "conv_id long, turn long, seq long, kind string, role string, text string"
    got = chat.messages(spark.createDataFrame(events, schema).repartition(5)).collect()
    assert sorted((m["conv_id"], m["turn"], m["role"], m["text"]) for m in got) == plain_messages(events)


def test_streamed_rows_come_back(spark):
    rng = random.Random(8)
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [(conv, turn, rng.choice(["user", "assistant", None]), rng.choice([None, "", "é", "ab", "long text " * 40]) )
            for conv in (None, 1, 2, 3) for turn in (None, low, low + 1, -3, 0, 1, 1, 1, 2, 3, 7, high - 1, high)]
    rows += [(4, turn, "assistant", f"answer {turn}") for turn in range(300)] * 2
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    log = chat.streamed_events(frame)
    kinds = {row["kind"]: row["count"] for row in log.groupBy("kind").count().collect()}
    assert set(kinds) == {"message", "delta", "edit", "regenerate"} and kinds["delta"] == len(rows)
    assert log.filter("seq < turn").count() > 50  # answers that a regeneration takes back

    def shown(rows_):
        return sorted(((c, t, r or "", x or "") for c, t, r, x in rows_), key=repr)

    said = chat.messages(log, within=chat.WITHIN).select("conv_id", "turn", "role", "text").collect()
    assert shown(said) == shown(rows)
    assert chat.messages(chat.streamed_events(frame.limit(0)), within=chat.WITHIN).collect() == []


def test_escaping_round_trip():
    rng = random.Random(2)
    bits = [*chat.CONTROL, "\\", "<", "[", "/", "|im_start|>", "s>", "INST]", "a", " ", "\n", ">>", "<\\s>", "[\\\\INST]", "|>", "é"]
    for _ in range(5000):
        text, role = ("".join(rng.choice(bits) for _ in range(rng.randint(0, n))) for n in (9, 4))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROL)
        shown, start, end = chat.render(role, text)
        assert chat.read(shown) == (role, text) and chat.unescape(shown[start:end]) == text


def test_conversation_digests(spark, tmp_path):
    rows = [
        (1, 0, "system", None, "x"), (1, 2, "assistant", "fine </s>", "x"), (1, 1, "user", "", "x"), (1, 3, "assistant", "é", "x"),
        (2, 0, "user", "same", "x"), (2, 0, "user", "same", "x"), (None, 0, None, "lost", "x"), (3, None, "assistant", "long " * 50_000, "x"),
    ]
    rows += [(4, t, "assistant", f"turn {t}", "x") for t in range(2000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string").repartition(4)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in catalog.op7_event_fold(spark, str(tmp_path)).collect()}
    said = defaultdict(list)
    for conv, turn, role, text, _ in sorted(rows + [(-7, 0, "user", "</s>[INST] ok [/INST]", ""), (-7, 1, "assistant", "</s>[INST] ok [/INST]", "")], key=lambda r: (str(r[0]), r[1] or 0)):
        said[conv].append((role or "", text or ""))
    assert set(got) == set(said)
    for conv, turns in said.items():
        learnt = "".join(t for r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(learnt) and got[conv]["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
        assert got[conv]["formatted_chars"] == sum(len(chat.render(r, t)[0]) for r, t in turns)
    frame.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert [r["conv_id"] for r in catalog.op7_event_fold(spark, f"{tmp_path}/none").collect()] == [-7]


# pages

PARAGRAPHS = [f"Sentence {i} of a text, with a few words more. And then some, number {i * 7}." for i in range(60)] + ["Short one", "word%%% other### a&b < c"]


@pytest.fixture(scope="session")
def trees():
    return html.train(PARAGRAPHS, layouts=300)


def extract(trees, page):
    parsed = html.Page(page)
    return parsed.text(parsed.decode(trees.log_odds(np.array(parsed.features(), dtype=float))))


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    rows = rng.random((3000, 3))
    labels = ((rows[:, 0] > 0.5) != (rows[:, 1] > 0.5)).astype(float)
    fitted = boosting.fit(rows, labels)
    fresh = rng.random((1000, 3))
    assert (((fresh[:, 0] > 0.5) != (fresh[:, 1] > 0.5)) == (fitted.log_odds(fresh) > 0)).mean() > 0.95


def test_decoding_is_the_best_consistent_set(trees):
    rng = np.random.default_rng(1)
    for _ in range(60):
        page = html.Page("".join(rng.choice(["<div>", "<p>", "</div>", "x"]) for _ in range(9)))
        odds = rng.normal(size=len(page.parent))
        kept = page.decode(odds)
        assert all(kept[page.parent[b]] for b in range(1, len(kept)) if kept[b])
        best = -np.inf
        for bits in range(1 << (len(odds) - 1)):
            chosen = [True] + [bool(bits >> b & 1) for b in range(len(odds) - 1)]
            if all(chosen[page.parent[b]] for b in range(1, len(odds)) if chosen[b]):
                best = max(best, sum(o for o, c in zip(odds, chosen) if c))
        assert sum(o for o, c in zip(odds, kept) if c) == pytest.approx(best)


def test_unseen_layouts_are_read_right(trees):
    built = html.Layouts(PARAGRAPHS, seed=123)
    right = 0
    for _ in range(150):
        page = html.Page(built.page())
        kept = page.decode(trees.log_odds(np.array(page.features(), dtype=float)))
        right += page.text(kept) == page.text(page.labels())
    assert right >= 143


def test_a_page_as_people_write_them(trees):
    page = """<!doctype html><HTML><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
      <div id="cookie-banner"><p>We use cookies, please agree to them now.</p><button>OK</button></div>
      <header class=site-header><a href=/>Home</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
      <main class="content"><article><h1>A  title &amp; more</h1><p>First &lt;b&gt; paragraph,\n with <b>bold</b>&nbsp;text.
      <p>Second one, <a href=/x>with a link</a>.<br>And a line. &#233;&#x4e2d;<ul><li>Item one of the list.<li>Item two of the list.</ul>
      <script>track()</script><p>The last paragraph of the article, long enough to count as text.</p></article>
      <section class="comments"><h3>Comments</h3><p>I liked this very much, thank you all.</p></section></main>
      <aside class="sidebar"><p>Read also this story, it is good.</p></aside><footer>&copy; 2024 Someone</footer></body></html>"""
    assert extract(trees, page).split("\n") == [
        "A title & more", "First <b> paragraph, with bold text.", "Second one, with a link. And a line. é中", "Item one of the list.",
        "Item two of the list.", "The last paragraph of the article, long enough to count as text.",
    ]


@pytest.mark.parametrize("inner", [
    "<script>x()</script>", "<style>p {}</style>", "<svg><path/></svg>", "<noscript>on</noscript>", "<button>OK</button>",
    "<template><p>x</p></template>", "<select><option>1</select>", "<iframe>x</iframe>", "<!-- x -->", "<input>",
])
def test_dropped_elements_cut_no_line(trees, inner):
    page = f"<article><p>Some words {inner}go on here, in the same line.</p><p>Then the next line of the article, too.</p></article>"
    assert html.Page(page).text_of_all().split("\n") == ["Some words go on here, in the same line.", "Then the next line of the article, too."]


@pytest.mark.parametrize("tag", ["math", "object", "audio", "video", "canvas"])
def test_contents_of_other_elements_stay_in_their_line(tag):
    assert html.Page(f"<p>Let <{tag}>x + 1</{tag}> be given.</p>").text_of_all() == "Let x + 1 be given."


@pytest.mark.parametrize("page", ["<div>" * 100_000, "<div>" * 50_000 + "</span>" * 50_000, "<p><b>" * 50_000, "<ul>" + "<li><div>" * 50_000, "<body>" * 100_000])
def test_parsing_takes_linear_time(page):
    began = time.process_time()
    html.Tree(page)
    assert time.process_time() - began < 5


def test_page_rows(spark, trees):
    long_page = "<article>" + "<p>Some words of a paragraph, and more.</p>" * 5000 + "</article>"
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<p>", "x"), (3, "u", "<<<>><div", "x"), (4, "u", long_page, "x"), (4, "u", long_page, "x"), (5, "u", "<div>" * 3000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.main_text(pages, trees).collect()
    assert len(got) == 7
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["id"] in (1, 2)] == ["", ""]
    assert {r["text"].count("\n") for r in got if r["id"] == 4} == {4999}
    assert html.main_text(pages.limit(0), trees).count() == 0
    assert html.sample_paragraphs(pages.limit(0)) == []


# mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        left, open_ = left - sum(2 * sizes[s] for s in full), open_ - full
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 500, "c": 40, "d": 3, None: 77}, {"a": 0, None: 0}, {"z": 5}, {"é": 100, "z": 1, "Z": 7, "\U0001f600": 50}])
def test_targets_equal_repeated_sharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000])
def test_permutations(size):
    assert sorted(mixing.permute(np.arange(size), size, 9).tolist()) == list(range(size))


def test_shards_use_every_slot_once():
    slots = np.array([500, 3, 0, 120], dtype=np.int64)
    seen, at = np.zeros(4, dtype=np.int64), 0
    for shard in range(10):
        counts, before = mixing.shard_counts(slots, shard, 10, 64, 1)
        assert (before == seen).all() and counts.sum() == min(64, 623 - at)
        seen, at = seen + counts, at + int(counts.sum())
    assert (seen == slots).all()


@pytest.mark.parametrize("block_words", [7, 64])
def test_mix_meets_targets_and_covers_blocks(spark, block_words):
    rng = random.Random(5)
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(rng.randint(0, 60))), rng.choice(["a", "a", "a", "b", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    options = {"block_words": block_words, "slots_per_shard": 16}
    placed, pieces = mixing.mix(df, **options)
    got = mixing.taken_words(placed, pieces).collect()
    assert len(got) == 300
    sums, target = Counter(), {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sums[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(sums[s] - target[s]) <= 1 for s in target)
    filled = defaultdict(list)
    for p in pieces.collect():
        filled[p["shard"], p["slot"]].append((p["place"], p["end_word"] - p["first_word"]))
    short = 0
    for parts in filled.values():
        at = 0
        for place, length in sorted(parts):
            assert place == at
            at += length
        short += at < block_words
    assert short <= 2 * len(target)
    again = mixing.taken_words(*mixing.mix(df.repartition(7), **options)).collect()
    assert sorted((r["id"], r["taken"]) for r in again) == sorted((r["id"], r["taken"]) for r in got)
    texts, counted = dict((i, t) for i, t, _ in rows), Counter()
    for r in mixing.mixed_documents(df.withColumn("n_chars", F.length("text")), **options).collect():
        assert r["n_chars"] == len(r["text"])
        assert all(line in texts[r["doc_id"]] for line in r["text"].split("\n"))
        counted[r["doc_id"]] += len(r["text"].split())
    assert counted == Counter({r["id"]: r["taken"] for r in got if r["taken"]})


def test_odd_rows_are_mixed(odd_documents, no_documents):
    got = mixing.taken_words(*mixing.mix(odd_documents)).collect()
    assert len(got) == odd_documents.count()
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    mixed = mixing.mixed_documents(odd_documents)
    assert mixed.columns == odd_documents.columns and mixed.filter("row <> 'extra'").count() == 0
    assert mixing.taken_words(*mixing.mix(no_documents)).count() == mixing.mixed_documents(no_documents).count() == 0


def test_slots_are_not_broadcast(spark):
    """The planner sees a range of shards, but each gives many slots."""
    frame = spark.createDataFrame([(k, "a b c", "s") for k in range(50)], "doc_id long, text string, source string")
    _, pieces = mixing.mix(frame)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not any("Broadcast" in line and "block" in line for line in plan.splitlines())


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    rows = [(k, "a b", f"s{k % 4}") for k in range(8)]
    with pytest.raises(ValueError, match="sources"):
        mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))


# sharding


def test_shards_are_gapless_and_even(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 300)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ring.shard_rows(df, size=ring.text_bytes("text")).collect()
    loads, slots = Counter(), defaultdict(list)
    for r in got:
        loads[r["shard"]] += len(r["text"]) + 1
        slots[r["shard"]].append(r["slot"])
    mean = sum(loads.values()) / 16
    assert len(loads) == 16 and max(loads.values()) <= mean * (1 + ring.SLACK) + 301 and min(loads.values()) >= 0.95 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {r["doc_id"]: r["shard"] for r in ring.shard_rows(df.repartition(3), size=ring.text_bytes("text")).collect()}
    assert again == {r["doc_id"]: r["shard"] for r in got}
    more = {r["doc_id"]: r["shard"] for r in ring.shard_rows(df, size=ring.text_bytes("text"), shards=17).collect()}
    assert sum(more[i] != s for i, s in again.items()) < 0.35 * len(again)


def test_rows_below_the_bound_stay_with_the_first_node(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(0).alias("size"))
    got = {r["doc_id"]: r["shard"] for r in ring.shard_rows(df, slack=100.0).collect()}
    nodes = spark.range(16 * ring.VIRTUAL_NODES).selectExpr(
        "cast(shiftrightunsigned(xxhash64('shard', id div 64, id % 64), 48) as int) AS at", "cast(id div 64 as int) AS shard"
    ).collect()
    spots = df.selectExpr(
        "doc_id", "cast(shiftrightunsigned(xxhash64('row', doc_id, xxhash64(false, size), 0L), 48) as int) AS at"
    ).collect()
    for spot in spots:
        first = min((n for n in nodes), key=lambda n: ((n["at"] - spot["at"]) % ring.CELLS, n["shard"]))
        assert got[spot["doc_id"]] == first["shard"]


def plain_walk(cells, preferences, shards, slack):
    """Arcs offered round by round: a shard keeps what it holds and takes the larger arcs first, while the sum fits."""
    capacity = sum(load for load, _ in cells.values()) / shards * (1 + slack)
    turn, held = dict.fromkeys(cells, 0), dict.fromkeys(cells, False)
    while True:
        while any(not held[c] and turn[c] < shards for c in cells):
            asked = defaultdict(list)
            for c in cells:
                if turn[c] < shards:
                    asked[preferences[c][turn[c]]].append(c)
            for offers in asked.values():
                total = 0
                for c in sorted(offers, key=lambda c: (not held[c], -cells[c][0], c)):
                    total += cells[c][0]
                    held[c] = total <= capacity
                    turn[c] += not held[c]
        left = [c for c in cells if not held[c]]
        if not left:
            return {c: preferences[c][turn[c]] for c in cells}
        capacity += max(cells[c][0] for c in left)
        for c in left:
            turn[c] = 0


def test_overflow_walk_equals_a_plain_one(spark):
    """With full shards: arcs that do not fit go on clockwise, as a replay in plain Python says."""
    rng = random.Random(11)
    points = [(int(r["at"]), r["shard"]) for r in spark.range(5 * ring.VIRTUAL_NODES).selectExpr(
        f"shiftrightunsigned(xxhash64('shard', id div {ring.VIRTUAL_NODES}, id % {ring.VIRTUAL_NODES}), 48) AS at",
        f"cast(id div {ring.VIRTUAL_NODES} as int) AS shard",
    ).collect()]
    cells = {c: (rng.randint(1, 400), 1) for c in rng.sample(range(ring.CELLS), 900)}
    preferences = {}
    for c in cells:
        met = sorted(((p - c) % ring.CELLS, shard) for p, shard in points)
        preferences[c] = list(dict.fromkeys(shard for _, shard in met))
    table = ring._preferences(spark, 5, ring.VIRTUAL_NODES)
    wanted = {c: preferences[c] for c in cells}
    assert {r["cell"]: r["choices"] for r in table.collect() if r["cell"] in cells} == wanted
    loads = spark.createDataFrame([(c, l, n) for c, (l, n) in cells.items()], "cell int, load long, rows long")
    for slack in (ring.SLACK, 0.3):
        got = {r["cell"]: r["shard"] for r in ring._settle(table.join(loads, "cell"), 5, slack).collect()}
        assert got == plain_walk(cells, preferences, 5, slack)


@pytest.mark.parametrize("kind", ["null ids", "one id", "equal rows"])
def test_a_hot_id_is_spread(spark, kind):
    """A third of the rows with one id, or equal as a whole."""
    rng = random.Random(4)
    hot = {"null ids": None, "one id": 7, "equal rows": 7}[kind]
    rows = [(i + 10, "x" * rng.randint(0, 300)) for i in range(2000)]
    rows += [(hot, "y" * (150 if kind == "equal rows" else rng.randint(0, 300)) + ("" if kind == "equal rows" else str(k))) for k in range(1000)]
    got = ring.shard_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), size=ring.text_bytes("text"), tie="text").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted((i or 0, t) for i, t in rows)
    loads, slots = Counter(), defaultdict(list)
    for r in got:
        loads[r["shard"]] += len(r["text"]) + 1
        slots[r["shard"]].append(r["slot"])
    assert max(loads.values()) <= sum(loads.values()) / 16 * (1 + ring.SLACK) + 306
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows_are_sharded(spark, odd_documents, no_documents):
    got = ring.shard_rows(odd_documents, size=ring.text_bytes("text"))
    assert got.count() == odd_documents.count()
    assert set(got.columns) == set(odd_documents.columns)
    assert got.filter("shard NOT BETWEEN 0 AND 15 OR row <> 'extra'").count() == 0
    assert got.groupBy("shard").agg((F.max("slot") + 1 != F.count("*")).alias("gap")).filter("gap").count() == 0
    assert ring.shard_rows(no_documents, size=ring.text_bytes("text")).count() == 0


# reputation


def test_hosts_paths_and_rules(spark):
    urls = {
        "http://WWW.Example.com/en/1?x=/es/": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://a.net/es/#t": ("a.net", "/es/", "net/es/", "block"), "http://a.net?q=/es/": ("a.net", "", None, "allow"),
        "http://com": ("com", "", None, "allow"), "x.com/a": ("", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"), None: ("", "", None, "allow"),
        "http://É.ORG/\nfr/": ("É.org", "/\nfr/", None, "allow"), "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("extra"))
    labels = spark.createDataFrame([], "label_id long, bad int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in reputation.url_verdicts(pages, labels).collect()}
    assert got == dict(enumerate(urls.values()))
    assert [r["n"] for r in reputation.host_reputation(spark.createDataFrame([], "host string, n long, bad long")).collect()] == []
    assert reputation.url_verdicts(pages.limit(0), labels).count() == 0


def test_hosts_are_judged_with_their_kin(spark):
    rows, labels, number = [], [], 0
    for host, count, bad in [("bad.evil.org", 60, 58), ("worse.evil.org", 40, 40), ("new.evil.org", 1, 1), ("good.fine.org", 80, 2), ("one.fine.org", 1, 1)]:
        for k in range(count):
            rows.append((number, f"http://{host}/en/{number}"))
            labels.append((number, int(k < bad)))
            number += 1
    rows += [(number, "http://unseen.evil.org/en/x"), (number, "http://unseen.evil.org/en/x")]
    labels += [(None, 1), (3, None), (0, 1)]
    verdicts = reputation.url_verdicts(
        spark.createDataFrame(rows, "page_id long, url string").repartition(3), spark.createDataFrame(labels, "label_id long, bad int")
    )
    got = {r["host"]: (r["verdict"], r["posterior"]) for r in verdicts.collect()}
    assert verdicts.count() == len(rows)
    assert [got[h][0] for h in ("bad.evil.org", "worse.evil.org", "new.evil.org", "unseen.evil.org")] == ["block"] * 4
    assert got["good.fine.org"][0] == got["one.fine.org"][0] == "allow"
    assert got["good.fine.org"][1] < got["one.fine.org"][1] < got["unseen.evil.org"][1] < got["worse.evil.org"][1]


def test_suffixes_and_domains_without_labels(spark):
    """Hosts, domains and suffixes with and without labelled pages side by side."""
    urls = ["http://a.net/en/1", "http://b.org/en/2", "http://a.org/x", "http://c.d.org/en/4", "http://e.info/", "junk"]
    pages = spark.createDataFrame(list(enumerate(urls, 1)), "page_id long, url string")
    for labels in ([(1, 1)], [(1, 0), (4, 1)], [(9, 1)], [(None, None)]):
        verdicts = reputation.url_verdicts(pages, spark.createDataFrame(labels, "label_id long, bad int")).collect()
        assert len(verdicts) == len(urls) and all(0 < v["posterior"] < 1 for v in verdicts)


def test_suffixes_are_a_parameter(spark):
    hosts = spark.createDataFrame([("a.com.mx",), ("x.b.com.mx",), ("com.mx",), ("mx",), ("",), ("k.city.kobe.jp",)], "host string")
    suffixes = ("com.mx", "city.kobe.jp")
    got = hosts.select("host", reputation.suffix_of(F.col("host"), suffixes).alias("s"), reputation.domain_of(F.col("host"), suffixes).alias("d")).collect()
    assert {r["host"]: (r["s"], r["d"]) for r in got} == {
        "a.com.mx": ("com.mx", "a.com.mx"), "x.b.com.mx": ("com.mx", "b.com.mx"), "com.mx": ("com.mx", "com.mx"),
        "mx": ("mx", "mx"), "": ("", ""), "k.city.kobe.jp": ("city.kobe.jp", "k.city.kobe.jp"),
    }
    outcomes = spark.createDataFrame([("a.com.mx", 50, 50), ("b.com.mx", 1, 0), ("c.com.mx", 40, 0)], "host string, n long, bad long")
    apart = {r["host"]: r["posterior"] for r in reputation.host_reputation(outcomes, suffixes=("com.mx",)).collect()}
    together = {r["host"]: r["posterior"] for r in reputation.host_reputation(outcomes, suffixes=()).collect()}
    assert apart["a.com.mx"] > 0.9 and apart["c.com.mx"] < 0.1 and apart["b.com.mx"] != together["b.com.mx"]


# pipeline


def test_stages_take_what_was_kept(spark, tmp_path):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(40)
    rows = [(i, text(120), "en", rng.choice("abc")) for i in range(200)]
    rows += [(1000 + i, rows[i][1], "en", "a") for i in range(20)]
    rows += [(2000 + i, f"{text(30)} {passage} {text(30)}", "en", "b") for i in range(15)]
    rows += [(3000 + i, f"{text(30)} nasty vileness {text(60)}", "en", "c") for i in range(60)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    documents.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(r[0], 1, int(r[0] >= 3000)) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert set(r["doc_id"] for r in out) <= set(range(200))
    assert len({r["doc_id"] for r in out}) > 150
    sizes = Counter()
    for r in out:
        sizes[r["shard"]] += 1
        assert r["slot"] >= 0 and r["n_chars"] == len(r["text"])
    assert sum(sizes.values()) == len(out) and set(sizes) <= set(range(16))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    no_rows = documents.limit(0)
    no_rows.write.parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
