"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.base import held_out, staged, text_of

WORD_BITS = 15
BUCKETS = 16
STATISTICS = 14
METADATA = 2
SIZE = (1 << WORD_BITS) + BUCKETS * (STATISTICS + METADATA) + BUCKETS
UPPER, LOWER, DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
HIGH = bytes(range(128, 256))


def _count(text: bytes, wanted: bytes) -> int:
    return len(text) - len(text.translate(None, wanted))


def _log(value: float) -> int:
    return min(BUCKETS - 1, int(np.log2(value + 1)))


def _share(part: float, whole: float) -> int:
    return min(BUCKETS - 1, int(BUCKETS * part / whole)) if whole else 0


class Extractor:
    """(indexes, values) of a document: words, then one bucket for each statistic and each metadata value."""

    def __init__(self) -> None:
        self.hashes: dict[bytes, int] = {}

    def _bucket(self, word: bytes) -> int:
        found = self.hashes.get(word)
        if found is None:
            if len(self.hashes) > 500_000:
                self.hashes.clear()
            found = self.hashes[word] = zlib.crc32(word) >> (32 - WORD_BITS)
        return found

    def __call__(self, text: str, n_chars: float) -> tuple[np.ndarray, np.ndarray]:
        raw = text.encode("utf-8", "replace")
        words = raw.split()
        tally, n = Counter(raw.lower().split()), len(words)
        slots = np.fromiter(map(self._bucket, tally), dtype=np.int64, count=len(tally))
        weights = np.log1p(np.fromiter(tally.values(), dtype=np.float64, count=len(tally)))
        norm = np.sqrt((weights ** 2).sum()) or 1.0
        lines = [line for line in raw.split(b"\n") if line.strip()]
        upper, lower, marks = _count(raw, UPPER), _count(raw, LOWER), _count(raw, MARKS)
        statistics = [
            _log(n), min(BUCKETS - 1, len(raw) // n if n else 0), _share(upper, upper + lower),
            _log(16 * marks / n if n else 0), _share(_count(raw, DIGIT), len(raw)),
            _share(sum(word[-1] in MARKS for word in words), n), _share(len(lines) - len(set(lines)), len(lines)),
            _share(len(tally), n), _share(max(tally.values(), default=0), n), _log(64 * len(lines) / n if n else 0),
            _share(_count(raw, HIGH), len(raw)), _log(max(map(len, words), default=0)),
            _log(16 * _count(raw, b"#*$%&|<>") / n if n else 0), _log(16 * raw.count(b"!") / n if n else 0)]
        given = 0 if np.isnan(n_chars) else n_chars
        metadata = [0 if np.isnan(n_chars) else 1 + min(BUCKETS - 2, int(np.log2(max(given, 0) + 1)) // 2),
                    2 if np.isnan(n_chars) else int(given != len(text))]
        more = np.array([i * BUCKETS + b for i, b in enumerate(statistics + metadata)]) + (1 << WORD_BITS)
        return (np.concatenate([slots, more]).astype(np.int32),
                np.concatenate([weights / norm, np.full(len(more), 0.5)]).astype(np.float32))


class Machine:
    """Bias, weights and factors; everything a score needs, whatever the corpus: a few megabytes."""

    def __init__(self, factors: int, seed: int = 7):
        random = np.random.default_rng(seed)
        self.bias = 0.0
        self.weights = np.zeros(SIZE)
        self.factors = random.normal(0, 0.02, (SIZE, factors))

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the factor sums; documents lie end to end, none is empty.

        The pairwise sum over i < j of <v_i, v_j> x_i x_j is half of the square
        of the sum minus the sum of the squares, so time is linear in the words.
        """
        x = value[:, None] * self.factors[index]
        sums = np.add.reduceat(x, starts, axis=0)
        squares = np.add.reduceat((x * x).sum(1), starts)
        linear = np.add.reduceat(value * self.weights[index], starts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int, rate: float,
            decay: float, batch: int, seed: int) -> None:
        """Logistic loss by adaptive gradients over shuffled batches."""
        random, width = np.random.default_rng(seed), self.factors.shape[1]
        seen_b, seen_w, seen_v = 1e-6, np.full(SIZE, 1e-6), np.full((SIZE, width), 1e-6)
        for _ in range(epochs):
            order = random.permutation(len(rows))
            for at in range(0, len(order), batch):
                own = order[at:at + batch]
                index = np.concatenate([rows[i][0] for i in own])
                value = np.concatenate([rows[i][1] for i in own]).astype(np.float64)
                lengths = np.array([len(rows[i][0]) for i in own])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                score, sums = self.raw(index, value, starts)
                error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[own]) / len(own)
                each = np.repeat(error, lengths) * value
                used, place = np.unique(index, return_inverse=True)
                by_weight = np.bincount(place, each) + decay * self.weights[used]
                pull = each[:, None] * (np.repeat(sums, lengths, axis=0) - value[:, None] * self.factors[index])
                by_factor = np.stack([np.bincount(place, pull[:, f]) for f in range(width)], 1)
                by_factor += decay * self.factors[used]
                seen_b += error.sum() ** 2
                seen_w[used] += by_weight ** 2
                seen_v[used] += by_factor ** 2
                self.bias -= rate * error.sum() / np.sqrt(seen_b)
                self.weights[used] -= rate * by_weight / np.sqrt(seen_w[used])
                self.factors[used] -= rate * by_factor / np.sqrt(seen_v[used])

    def packed(self) -> bytes:
        return np.concatenate([[self.bias], self.weights, self.factors.ravel()]).astype(np.float32).tobytes()

    def load(self, packed: bytes) -> None:
        numbers = np.frombuffer(packed, np.float32).astype(np.float64)
        self.bias, self.weights = float(numbers[0]), numbers[1:SIZE + 1]
        self.factors = numbers[SIZE + 1:].reshape(SIZE, -1)


def _averaged(models: pd.DataFrame) -> pd.DataFrame:
    """One model out of those of a round's blocks, each weighing as its rows."""
    models = models.sort_values(["rows", "model"])
    total = models["rows"].sum()
    mean = sum(np.frombuffer(m, np.float32).astype(np.float64) * (n / total)
               for n, m in zip(models["rows"], models["model"]))
    return pd.DataFrame({"rows": [total], "model": [mean.astype(np.float32).tobytes()]})


def training_rows(docs: DataFrame, labels: DataFrame, folds: int, most_rows: int) -> tuple[DataFrame, int]:
    """(place, y, index, value) of labelled documents outside fold 0, and how many: ``most_rows`` at most."""
    spark = docs.sparkSession
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out("doc_id", folds))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    texts = docs.select(F.col("doc_id"), text_of("text").alias("text"), F.col("n_chars").cast("double"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extractor = Extractor()
        for batch in batches:
            found = [extractor(t, c) for t, c in zip(batch["text"], batch["n_chars"])]
            yield pd.DataFrame({"place": batch["place"], "y": batch["y"], "index": [i.tobytes() for i, _ in found],
                                "value": [v.tobytes() for _, v in found]})

    # At most ``most_rows`` ids and labels, so the texts are not shuffled for them.
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text", "n_chars"]).select(
        "text", "n_chars", "y", F.xxhash64("doc_id", "text", "n_chars").alias("place"))
    rows = staged(spark, rows.mapInPandas(extract, "place long, y int, index binary, value binary"), "fm-rows")
    count = rows.count()
    if count > most_rows:
        last = rows.select("place").orderBy("place").limit(most_rows).agg(F.max("place")).first()[0]
        rows, count = rows.filter(F.col("place") <= last), most_rows
    return rows, count


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, most_rows: int = 20_000, block_rows: int = 2_500,
          factors: int = 8, rounds: int = 4, epochs: int = 3, rate: float = 0.1, decay: float = 1e-5) -> Machine:
    """Fits a machine on labelled rows outside fold 0: at most ``most_rows``, those of the lowest id hash.

    The rows are dealt into blocks of about ``block_rows``. In each round every
    block trains a copy of the machine in a task of its own, and one more task
    averages the copies, ``most_rows / block_rows`` of fixed size: the driver sees
    one model of a megabyte.
    Ids labelled several times count once, as the majority says. Rows that agree
    in id, text and ``n_chars`` are one; where an id has several texts, they are
    rows of their own, and ``most_rows`` bounds the rows too. Labels without a
    document, or null, are ignored; without labels the scores are all 0.5.
    """
    spark, machine = docs.sparkSession, Machine(factors)
    rows, count = training_rows(docs, labels, folds, most_rows)
    if not count:
        return machine
    blocks = -(-count // block_rows)

    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(machine.packed())

        def fit(block: pd.DataFrame) -> pd.DataFrame:
            own = Machine(factors)
            own.load(shared.value)
            block = block.sort_values(["place", "index"], kind="stable")
            data = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32))
                    for i, v in zip(block["index"], block["value"])]
            own.fit(data, block["y"].to_numpy(float), epochs, rate, decay, 64, turn)
            return pd.DataFrame({"rows": [len(block)], "model": [own.packed()]})

        fitted = rows.groupBy(F.pmod("place", F.lit(blocks)).alias("block")).applyInPandas(fit, "rows long, model binary")
        # ``most_rows / block_rows`` models at most meet in one task; the driver sees the one they become.
        together = fitted.withColumn("together", F.lit(0)).groupBy("together")
        merged = together.applyInPandas(_averaged, "rows long, model binary").first()
        machine.load(bytes(merged["model"]))
        shared.destroy()
    return machine


def scored(docs: DataFrame, machine: Machine, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` and ``held_out``, of every whole text.

    A score depends on text and ``n_chars`` alone. A null text is empty; an
    empty text is scored by its statistics; a null ``n_chars`` is a value of its
    own. Repeated rows get equal scores; an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine.packed())
    width = machine.factors.shape[1]

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        extractor, own = Extractor(), Machine(width)
        own.load(model.value)
        for texts, chars in batches:
            out, at = [], 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and size < 2_000_000 and stop - at < 256:
                    size += len(texts.iloc[stop])
                    stop += 1
                found = [extractor(t, c) for t, c in zip(texts.iloc[at:stop], chars.iloc[at:stop])]
                lengths = [len(i) for i, _ in found]
                raw, _ = own.raw(np.concatenate([i for i, _ in found]), np.concatenate([v for _, v in found]),
                                 np.concatenate([[0], np.cumsum(lengths)[:-1]]))
                out.append(1 / (1 + np.exp(-np.clip(raw, -30, 30))))
                at = stop
            yield pd.Series(np.concatenate(out) if out else np.array([], dtype=float))

    # Evaluated once, though held in two columns.
    value: Column = score.asNondeterministic()(text_of("text"), F.col("n_chars").cast("double"))
    return docs.withColumn("score", value).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")).withColumn("held_out", held_out("doc_id", folds))


def accepted(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns alone."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*columns).alias("row"), "doc_id", "text", "n_chars")
    return scored(whole, machine, threshold).filter("predicted = 1").select("row.*")
