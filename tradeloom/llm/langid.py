"""Language identification by cross-parsing.

Each language has a suffix automaton of words of its labelled texts. A text's
word, with a space on either side, is cut into phrases, each the longest match
from its start; no phrase crosses a word, so a word's phrases are counted once
for each worker and remembered. The language that needs the fewest phrases for
each letter wins.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.runtime import begins, ship, thinned, windowed

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
MEMO_WORDS, LONG_WORD = 150_000, 64


class SuffixAutomaton:
    """States by their transitions; the text's substrings are the paths from state 0."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = state
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[state] = clone
            last = state

    def phrases(self, text: str) -> int:
        """Longest matches that make up the text; a character that occurs nowhere is a phrase of its own."""
        n, state, states = 0, self.next[0], self.next
        root = state
        for c in text:
            to = state.get(c)
            if to is None:
                # The phrase ends here, and the next begins with this character.
                n += state is not root
                to = root.get(c)
                if to is None:
                    n += 1
                    state = root
                    continue
            state = states[to]
        return n + (state is not root)


@dataclass(frozen=True)
class Languages:
    """Each language's reference: words between single spaces."""

    references: dict[str, str]


class Parses(dict):
    """Row of ``counts`` that holds a word's phrases in each language and, last, its parsed characters and its letters."""

    def __init__(self, languages: Languages):
        super().__init__()
        self.names = sorted(languages.references)
        self.automata = [SuffixAutomaton(languages.references[n]) for n in self.names]
        self.counts = np.zeros((MEMO_WORDS + 1, len(self.names) + 2), np.int32)

    def of(self, word: str) -> list[int]:
        letters = sum(map(str.isalpha, word))
        return [a.phrases(f" {word} ") if letters else 0 for a in self.automata] + [len(word) + 2 if letters else 0, letters]

    def __missing__(self, word: str) -> int:
        row = len(self)
        self.counts[row] = self.of(word)
        self[word] = row
        return row

    def total(self, text: str) -> np.ndarray:
        """Phrases of a whole text in each language, its parsed characters (words with a space on either side), its letters."""
        words = WORD.findall(text.lower())
        out = np.zeros(self.counts.shape[1], np.int64)
        for start in range(0, len(words), 50_000):
            part = words[start : start + 50_000]
            if len(self) + len(part) > MEMO_WORDS:
                self.clear()
            if max(map(len, part)) > LONG_WORD:
                for w in part:
                    if len(w) > LONG_WORD:
                        out += self.of(w)
                part = [w for w in part if len(w) <= LONG_WORD]
            out += self.counts[np.fromiter(map(self.__getitem__, part), np.int64, len(part))].sum(axis=0)
        return out


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", windows: int = 200, window_bytes: int = 1 << 16, reference_chars: int = 60_000) -> Languages:
    """References from rows with a language. Null and empty texts and null languages are left out; no rows give no languages.

    Texts of any length are cut into windows of ``window_bytes``. For each language the ``windows`` different ones least by
    a hash go to the driver; the reference is their distinct words, the most frequent first, up to ``reference_chars``; words
    over LONG_WORD letters stand as pieces of that length. So the driver holds a bounded sample. Equal windows count
    once. Other columns are not read.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull())
    rows = windowed(rows, "text", window_bytes)
    few = thinned(rows, F.col("text"), windows, "lang").groupBy("lang", F.xxhash64("text").alias("draw")).agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    counts: dict[str, Counter] = {}
    for r in few.withColumn("place", place).where(F.col("place") <= windows).select("lang", "text").collect():
        words = WORD.findall(r.text.lower())
        counts.setdefault(r.lang, Counter()).update(w[k : k + LONG_WORD] for w in words for k in range(0, len(w), LONG_WORD))
    references = {}
    for lang, found in counts.items():
        words, size = [], 0
        for w in sorted(found, key=lambda w: (-found[w], w)):
            size += len(w) + 1
            if size > reference_chars:
                break
            words.append(w)
        if words:
            references[lang] = " " + " ".join(words) + " "
    return Languages(references)


def identify(docs: DataFrame, languages: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score.

    ``und`` with score 0 for a null text or one without a letter, or if no language was learned. Ties go to the first
    name. The score is the second language's share of the two lowest counts: 0.5 where they tie, near 1 where the
    winner is far ahead, and 1 for a single language. Repeated rows and null ids are answered each, an empty table with
    none. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    shared, key = spark.sparkContext.broadcast(languages), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parses = _parses(key, shared.value)
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text"):
                total = parses.total(text.as_py() or "") if parses.names else np.zeros(1)
                if not total[-1]:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                order = np.argsort(total[:-2], kind="stable")
                best = float(total[order[0]])
                names.append(parses.names[order[0]])
                scores.append(float(total[order[1]]) / (best + float(total[order[1]])) if len(order) > 1 else 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


#: A text is told by no language if the best needs so many phrases for each parsed character.
UNKNOWN = 0.95


def keep_identified(docs: DataFrame, languages: Languages, text_col: str = "text", unknown: float = UNKNOWN) -> DataFrame:
    """The rows, with all their columns, whose text is identified as one of the languages.

    Left out are texts that are null or have no letter, and those of which the winner knows next to nothing: its phrases are
    ``unknown`` of the parsed characters or more. A text in letters that no language has needs a phrase for each. Rows are
    judged one by one; an empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    shared, key, place = spark.sparkContext.broadcast(languages), uuid.uuid4().hex, docs.columns.index(text_col)

    def known(total: np.ndarray) -> bool:
        return bool(total[-1]) and total[:-2].min() < unknown * total[-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parses = _parses(key, shared.value)
        for batch in batches:
            kept = [bool(parses.names) and known(parses.total(t.as_py() or "")) for t in batch.column(place)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_made: dict[str, Parses] = {}


def _parses(key: str, languages: Languages) -> Parses:
    """One for a worker and a model: tasks that follow go on with what is remembered."""
    begins("languages", _made.clear)
    if key not in _made:
        _made.clear()
        _made[key] = Parses(languages)
    return _made[key]
