"""Quality rules as a short-circuit cascade, ordered by rejection per cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.base import text_of

SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30


def repeated_words(words: list[bytes], window: int) -> int:
    """Words in windows whose sequence occurs at least twice, by ranking ever longer windows exactly."""
    if len(words) <= window:
        return 0
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    codes, length = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)), 1
    while length < window:
        step = min(length, window - length)
        codes = codes[:len(codes) - step] * (codes.max() + 1) + codes[step:]
        values, codes = np.unique(codes, return_inverse=True)
        if len(values) == len(codes):
            return 0
        length += step
    twice = np.bincount(codes)[codes] > 1
    change = np.zeros(len(words) + 1, dtype=np.int64)
    change[:len(twice)] += twice
    change[window:window + len(twice)] -= twice
    return int((np.cumsum(change) > 0).sum())


class Text:
    """What the rules ask of a text, each computed when first asked for."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "replace")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def duplicate_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def repeated(self) -> int:
        return repeated_words(self.words, WINDOW)


def _few_letters(t: Text) -> bool:
    return 10 * sum(any(map(str.isalpha, w)) for w in t.raw.decode("utf-8").translate(_TO_SPACE).split(" ") if w
                    ) < 7 * len(t.words)


def _capitals(t: Text) -> bool:
    upper = len(t.raw) - len(t.raw.translate(None, UPPER))
    return upper > len(t.raw) - len(t.raw.translate(None, LOWER))


_TO_SPACE = str.maketrans(SPACES, " " * len(SPACES))

# Rule -> whether a text of enough words fails it. A text that fails one is not kept.
RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": lambda t: 10 * t.symbols > len(t.words),
    "word_length": lambda t: not 2 * len(t.words) <= t.word_chars <= 15 * len(t.words),
    "duplicate_lines": lambda t: 2 * t.duplicate_lines > len(t.lines),
    "letters": _few_letters,
    "capitals": _capitals,
    "stutter": lambda t: 10 * sum(map(eq, t.words, t.words[1:])) > 3 * len(t.words),
    "ellipses": lambda t: 10 * sum(line.endswith(("...", "…")) for line in t.lines) > 3 * len(t.lines),
    "bullets": lambda t: 10 * sum(line.startswith(("-", "*", "•")) for line in t.lines) > 9 * len(t.lines),
}


def base_failed(t: Text) -> bool:
    return len(t.words) < LEAST_WORDS or 100 * t.repeated > MOST_REPEATED * len(t.words)


def rule_order(docs: DataFrame, text_column: str = "text", sample_rows: int = 2_000, seed: int = 11) -> list[str]:
    """The rules by rejections per second on a sample, best first.

    Each rule runs alone on each sampled text, in Spark tasks; sums per rule come
    back. The order decides only how soon a text is rejected, never whether.
    """
    rows = docs.count()
    sample = docs.select(text_of(text_column).alias("text")).sample(min(1.0, sample_rows / max(rows, 1)), seed)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seconds, rejected = dict.fromkeys(RULES, 0.0), dict.fromkeys(RULES, 0)
        for batch in batches:
            for text in batch["text"]:
                for name, fails in RULES.items():
                    fresh, began = Text(text), time.perf_counter()
                    rejected[name] += bool(fails(fresh))
                    seconds[name] += time.perf_counter() - began
        yield pd.DataFrame({"rule": list(RULES), "seconds": list(seconds.values()),
                            "rejected": list(rejected.values())})

    measured = sample.mapInPandas(measure, "rule string, seconds double, rejected long").groupBy("rule").agg(
        F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()
    gain = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in measured}
    return sorted(RULES, key=lambda name: (-gain.get(name, 0.0), name))


VERDICT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, kept boolean")


def judged(docs: DataFrame, order: list[str] | None = None, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the five counts, base_failed, kept.

    The counts are of the whole text. A text that fails the base is not kept and
    no rule runs; else the rules run in ``order`` (by default that of
    ``rule_order``) until one rejects. A null text has no words, so it fails the
    base. Repeated rows are judged alike; an empty table gives an empty result;
    other columns are ignored.
    """
    names = order or rule_order(docs, text_column)

    @F.pandas_udf(VERDICT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                t = Text(text)
                failed = base_failed(t)
                kept = not failed and not any(RULES[name](t) for name in names)
                out.append((len(t.words), t.word_chars, t.symbols, t.duplicate_lines, t.repeated, failed, kept))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in VERDICT.split(", ")])

    verdict = judge.asNondeterministic()(text_of(text_column))
    return docs.select(F.col(id_column).alias("doc_id"), verdict.alias("v")).select("doc_id", "v.*")
