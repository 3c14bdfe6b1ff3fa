"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Every rule looks at one measure of a text and votes good, bad or not at all. Texts with equal votes are counted together,
so the model is fitted on a table of vote patterns whose size depends on the number of rules only. It has a share of good
texts and an accuracy for each rule; expectation-maximisation estimates both without labels, and the posterior
probability of a good text decides, in place of a demand that all rules be met.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import batch, cut

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
THRESHOLD = 0.5
MAX_STEPS = 200
TOLERANCE = 1e-7
# Before any text is seen: the share of good texts, and how often a voting rule is right on good and on bad ones. That
# rules are better than chance fixes the meaning of the two classes.
START = (0.85, 0.98, 0.3)
PRIOR_VOTES = 20

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
_MEASURES = (
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
    ("n_lines", "long"), ("n_ended_lines", "long"), ("n_letters", "long"), ("n_upper", "long"), ("n_bangs", "long"),
    ("n_distinct", "long"), ("most_common", "long"),
)


def measures(text: str | None) -> tuple[int, ...]:
    """The values named in ``_MEASURES`` for a whole text; null counts as empty."""
    text = text or ""
    tokens = text.encode().split()
    count = len(tokens)
    seen: set[str] = set()
    lines = doubled = ended = 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            lines += 1
            doubled += line in seen
            seen.add(line)
            ended += line.rstrip(_SPACES)[-1] in ".!?:;\"'"
    windows = Counter(zip(tokens, tokens[1:], tokens[2:]))
    repeated = 0
    if count > 2 and len(windows) < count - 2:
        reach = 0
        for at in range(count - 2):
            if windows[tokens[at], tokens[at + 1], tokens[at + 2]] > 1:
                repeated += at + 3 - max(reach, at)
                reach = at + 3
    frequency = Counter(tokens)
    upper = sum(map(str.isupper, text))
    return (
        count, len(text) - sum(map(text.count, _SPACES)), len(_SYMBOLS.findall(text)), doubled, repeated,
        lines, ended, sum(map(str.isalpha, text)), upper, text.count("!"),
        len(frequency), max(frequency.values(), default=0),
    )


def measured(documents: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, measures...)`` for every row; null ids and repeated rows stay, other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [measures(t.as_py()) for t in rows.column("text")]
            columns = zip(*found) if found else [[] for _ in _MEASURES]
            yield batch(id=rows.column("id"), **{name: pa.array(c, pa.int64()) for (name, _), c in zip(_MEASURES, columns)})

    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "id long, " + ", ".join(f"{n} {k}" for n, k in _MEASURES))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """Each rule's vote on the measures: 1 good, -1 bad, 0 abstains."""
    word_length = _share("word_chars", "n_words")
    symbols = _share("n_symbols", "n_words")
    doubled = _share("n_dup_lines", "n_lines")
    repeated = _share("n_repeat_words", "n_words")
    upper = _share("n_upper", "n_letters")
    bangs = _share("n_bangs", "n_words")
    ended = _share("n_ended_lines", "n_lines")
    common = _share("most_common", "n_words")
    return {
        "length": _vote(F.col("n_words") < LEAST_WORDS, F.col("n_words") >= 2 * LEAST_WORDS),
        "word_length": _vote((word_length < 2.5) | (word_length > 12), word_length.between(3.5, 9)),
        "symbols": _vote(symbols > 0.1, symbols < 0.01),
        "line_copies": _vote(doubled > 0.3, (doubled < 0.02) & (F.col("n_lines") > 2)),
        "word_copies": _vote(repeated > 0.3, repeated < 0.05),
        "capitals": _vote(upper > 0.4, (upper > 0.005) & (upper < 0.15)),
        "bangs": _vote(bangs > 0.1, (bangs < 0.01) & (F.col("n_words") >= LEAST_WORDS)),
        "line_ends": _vote((ended < 0.1) & (F.col("n_lines") > 2), ended > 0.7),
        "commonest": _vote((common > 0.25) & (F.col("n_words") > 10), (common < 0.15) & (F.col("n_words") >= LEAST_WORDS)),
        "letters": _vote(_share("n_letters", "word_chars") < 0.75, _share("n_letters", "word_chars") > 0.9),
    }


def fit(patterns: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The share of good texts, and how often each rule that votes is right on good and on bad ones.

    ``patterns`` has a row per vote pattern, ``counts`` how often each was seen. Two accuracies per rule, because a rule
    that finds one sort of junk is nearly always right on good texts and silent about the other sorts. Counts of a prior
    keep rules that hardly vote near the start values.
    """
    cast = patterns != 0
    share, on_good, on_bad = START[0], np.full(patterns.shape[1], START[1]), np.full(patterns.shape[1], START[2])
    for _ in range(MAX_STEPS):
        good = posterior(patterns, share, on_good, on_bad)
        weights = [counts[:, None] * cast * y[:, None] for y in (good, 1 - good)]
        fresh = [
            ((w * (patterns == vote)).sum(axis=0) + PRIOR_VOTES * start) / (w.sum(axis=0) + PRIOR_VOTES)
            for w, vote, start in zip(weights, (1, -1), START[1:])
        ]
        fresh_good = np.clip(fresh[0], 0.8, 0.999)
        fresh_bad = np.clip(fresh[1], 1.05 - fresh_good, 0.99)
        fresh_share = float((counts @ good + PRIOR_VOTES * START[0]) / (counts.sum() + PRIOR_VOTES))
        moved = max(np.abs(fresh_good - on_good).max(), np.abs(fresh_bad - on_bad).max(), abs(fresh_share - share))
        share, on_good, on_bad = fresh_share, fresh_good, fresh_bad
        if moved < TOLERANCE:
            break
    return share, on_good, on_bad


def evidence(on_good: np.ndarray, on_bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log odds for a good text that a good and a bad vote of each rule add."""
    return np.log(on_good / (1 - on_bad)), np.log((1 - on_good) / on_bad)


def posterior(patterns: np.ndarray, share: float, on_good: np.ndarray, on_bad: np.ndarray) -> np.ndarray:
    for_good, for_bad = evidence(on_good, on_bad)
    odds = np.log(share / (1 - share)) + (patterns == 1) @ for_good + (patterns == -1) @ for_bad
    return 1 / (1 + np.exp(-odds))


def judge(documents: DataFrame, *, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id, measures..., base_failed, quality, kept)`` for every row of ``documents``.

    ``quality`` is the posterior probability of a good text. A text fails the base if it has fewer than ``LEAST_WORDS`` words
    or repeats more than ``MOST_REPEATED_PERCENT`` of them; such a text is never kept and does not take part in the fit,
    and no other rule is a must. Null and empty texts fail the base. An empty table gives an empty one.
    """
    votes = rules()
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    voted = cut(
        measured(documents, id=id, text=text).withColumns({"votes": F.array(*votes.values()), "base_failed": failed})
    )
    seen = voted.filter("NOT base_failed").groupBy("votes").agg(F.count("*").alias("n")).collect()  # at most 3 ** rules
    patterns = np.array([r["votes"] for r in seen], dtype=float).reshape(-1, len(votes))
    share, on_good, on_bad = fit(patterns, np.array([r["n"] for r in seen], dtype=float))
    odds = F.lit(float(np.log(share / (1 - share))))
    for at, (for_good, for_bad) in enumerate(zip(*evidence(on_good, on_bad))):
        vote = F.col("votes")[at]
        odds = odds + F.when(vote == 1, float(for_good)).when(vote == -1, float(for_bad)).otherwise(0.0)
    return voted.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )
