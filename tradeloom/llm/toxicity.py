"""Toxicity by a weighted lexicon.

Words are folded: case, accents, homoglyphs of Latin letters and digits that
stand for letters. From labelled documents the folded words, and beginnings of
words, that speak for the label get a weight. An Aho-Corasick automaton finds
them in whole texts; a hit counts unless an exception phrase covers it. The
score is a logistic function of the weights found and their share of the text.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.runtime import ship, stored, thinned

# Cyrillic and Greek letters that look like Latin ones, and signs used for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "3", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ɡ": "g", "ı": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
# One sign can stand for i and for l, so that these are one letter after folding.
_SIGNS = str.maketrans(SUBSTITUTES | {"l": "i"})
_LOOKALIKES = str.maketrans(HOMOGLYPHS)
#: Signs stand for letters before and within a word, two at most in a row; after it, only dollar signs do.
_WORD = re.compile(r"[@$!|]{0,2}[^\W_]+(?:[@$!|]{1,2}[^\W_]+)*\${0,2}")
#: Lengths of the beginnings of words that can be entries.
PREFIXES = range(3, 8)


@functools.lru_cache(maxsize=200_000)
def fold_word(word: str) -> str:
    """A lower-case word in its folded form; one of digits alone stays as it is, without signs at its edges."""
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word.translate(_LOOKALIKES)) if not unicodedata.combining(c))
    return word.translate(_SIGNS) if any(c.isalpha() for c in word) else word.strip("@$!|")


def folded(text: str) -> list[str]:
    return [fold_word(w) for w in _WORD.findall(text.casefold())]


@dataclass(frozen=True)
class Lexicon:
    """Weights of entries, exception phrases, and the logistic function's coefficients."""

    weights: dict[str, float]  # " word " is a whole word, " begin" the beginning of one
    exceptions: tuple[str, ...]  # phrases of folded words between single spaces
    coefficients: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        for entry, weight in self.weights.items():
            if f"{entry}" not in found:
                found.add_word(entry, (len(entry), weight))
        found.make_automaton()
        return found


def hits(text: str, automaton: ahocorasick.Automaton) -> tuple[list[tuple[str, float]], int]:
    """Each matched word with its heaviest entry, words under exception phrases left out; and the number of words."""
    words = folded(text)
    if not words or not len(automaton):
        return [], len(words)
    line = " " + " ".join(words) + " "
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(line):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    found, excused, reach = [], sorted(excused), 0
    at = 0
    for start in sorted(best):
        while at < len(excused) and excused[at][0] <= start:
            reach, at = max(reach, excused[at][1]), at + 1
        if start >= reach:
            found.append((line[start + 1 : line.index(" ", start + 1)], best[start]))
    return found, len(words)


def features(text: str, automaton: ahocorasick.Automaton) -> tuple[float, float, float]:
    """Weight found, heaviest weight, and weight by the logarithm of the length."""
    found, n = hits(text, automaton)
    total = sum(w for _, w in found)
    return min(total, 50.0), max((w for _, w in found), default=0.0), min(total / (1.0 + np.log1p(n)), 50.0)


def probability(values: np.ndarray, coefficients: tuple[float, ...]) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(coefficients[0] + values @ np.asarray(coefficients[1:]), -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[float, ...]:
    """Ridge-regularised logistic regression by Newton's method; the intercept is free."""
    design = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-6, *[ridge] * x.shape[1]])
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        p = probability(x, tuple(w))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, design.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _odds(positive: Column, negative: Column, positives: int, negatives: int) -> Column:
    """Log odds of a term given one label and the other."""
    return F.log((positive + 0.5) / (positives + 1)) - F.log((negative + 0.5) / (negatives + 1))


def _weight(positive: Column, negative: Column, positives: int, negatives: int) -> Column:
    """Log odds, two standard errors down."""
    return _odds(positive, negative, positives, negatives) - 2 * F.sqrt(1 / (positive + 0.5) + 1 / (negative + 0.5))


def _distinct_entries(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Of entries that begin alike, those that say something of their own.

    A beginning of which one continuation has nearly all positives gives way to that: the word, or the longest common
    beginning of its forms, is what speaks. A continuation that weighs no more than a beginning that stays is dropped.
    """

    def beginnings(term: str) -> list[str]:
        return [term[: n + 1] for n in PREFIXES if n + 1 < len(term) and term[: n + 1] in found]

    gone = {b for term, (p, _) in found.items() for b in beginnings(term) if p >= 0.9 * found[b][0]}
    kept = {t: v for t, v in found.items() if t not in gone}
    return {t: w for t, (_, w) in kept.items() if not any(b in kept and kept[b][1] >= w for b in beginnings(t))}


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = 30_000) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents, the least by a hash of their ids.

    The ids are drawn first and broadcast, at most 16 bytes each, so that texts of others are not shuffled. Of rows that
    share an id the one whose text is least by a hash stands for it, so that repeated ids do not lift the bound. Labels
    without a document, and null labels or ids, are left out; an id with both labels is drawn with each.
    """
    drawn = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    drawn = thinned(drawn, F.col("doc_id"), sample).distinct().withColumn("draw", F.xxhash64("doc_id")).orderBy("draw", "doc_id", "toxic").limit(sample).drop("draw")
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    place = F.row_number().over(Window.partitionBy("doc_id", "toxic").orderBy(F.xxhash64("text"), "text"))
    return rows.withColumn("place", place).where("place = 1").select("text", "toxic")


def learn(labelled: DataFrame, exceptions: tuple[str, ...] = (), least: float = 1.5, entries: int = 20_000) -> Lexicon:
    """A lexicon from rows (text, toxic 0/1). Null texts are empty; null labels are left out.

    Keeps at most ``entries`` entries, the heaviest. Two-word phrases with an entry, in five clean texts at least, whose
    log odds are for a clean text become exceptions. The rows' three features come to the driver, so the caller bounds the rows.
    Without both labels the lexicon is empty and every score is the share of label 1 (0 without rows).
    """
    spark = labelled.sparkSession
    ship(spark)
    rows = stored(labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null"), "labelled")
    counts = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    if not positives or not negatives:
        share = (positives + 0.001) / (positives + negatives + 0.002) if counts else 1e-6
        return Lexicon({}, tuple(exceptions), (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(folded(text))
                seen[label].update({f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in PREFIXES if len(w) >= n})
            for label, found in enumerate(seen):
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([v * (label == 1) for v in found.values()], pa.int64()), pa.array([v * (label == 0) for v in found.values()], pa.int64())], names=["term", "p", "n"])

    weighed = rows.mapInArrow(terms, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    weighed = weighed.where("p > 2").withColumn("w", _weight(F.col("p"), F.col("n"), positives, negatives)).where(F.col("w") > least)
    weights = _distinct_entries({r.term: (r.p, r.w) for r in weighed.orderBy(F.desc("w"), "term").limit(entries).collect()})
    first = Lexicon(weights, tuple(exceptions))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = first.automaton()
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                found = {w for w, _ in hits(text, automaton)[0]}
                if found:
                    words = folded(text)
                    seen[label].update({f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a in found or b in found})
            for label, got in enumerate(seen):
                yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array([v * (label == 1) for v in got.values()], pa.int64()), pa.array([v * (label == 0) for v in got.values()], pa.int64())], names=["term", "p", "n"])

    told = rows.mapInArrow(phrases, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    told = told.where("n >= 5").withColumn("w", _odds(F.col("n"), F.col("p"), negatives, positives)).where(F.col("w") > 1)
    learned = [r.term for r in told.orderBy(F.desc("w"), "term").limit(entries).select("term").collect()]
    second = Lexicon(weights, (*exceptions, *learned))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = second.automaton()
        for batch in batches:
            values = [features(t, automaton) for t in batch["text"]]
            yield pd.DataFrame(values, columns=["a", "b", "c"]).assign(toxic=batch["toxic"].to_numpy())

    seen = rows.mapInPandas(measure, "a double, b double, c double, toxic int").toPandas()
    return Lexicon(weights, second.exceptions, logistic(seen[["a", "b", "c"]].to_numpy(), seen["toxic"].to_numpy()))


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score in [0, 1], predicted (1 from 0.5 on), and the matched words with their weights as JSON.

    A null or empty text has no hits; its score is that of a text without any. Repeated rows and null ids are answered
    each, an empty table with none. One pass, no shuffle; the lexicon is broadcast, its size bounded when it was learned. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in batches:
            values, told = [], []
            for text in batch.column("text").to_pylist():
                found, n = hits(text, automaton)
                total = sum(w for _, w in found)
                values.append((min(total, 50.0), max((w for _, w in found), default=0.0), min(total / (1.0 + np.log1p(n)), 50.0)))
                told.append(json.dumps({w: round(v, 3) for w, v in found}, ensure_ascii=False))
            p = probability(np.array(values, float).reshape(-1, 3), shared.value.coefficients)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(told, pa.string())], names=["doc_id", "score", "predicted", "matched"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int, matched string")
