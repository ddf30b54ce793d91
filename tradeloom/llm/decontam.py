"""Benchmark decontamination by an FM-index of each training shard.

A task takes its documents in shards of bounded size. The shard's words become
symbols of the benchmark's vocabulary; any other word, and any run of known
words too short to hold a window, becomes a separator. Over the text that is
left an FM-index is built: suffix array, Burrows-Wheeler transform in a wavelet
matrix, and sampled suffix positions. All windows of the benchmark are searched
backwards at once, occurrences are located by walking to the nearest sample,
and their words are merged to removal spans.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.runtime import begins, ship, slices, stored, utf8

# Fixed value: in UTF-8 the words are runs of these bytes, after A-Z are lowered.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_KEPT = bytes(c if WORD.fullmatch(bytes([c])) else 0x20 for c in range(256)).lower()
#: Bytes of text in a shard, and words of the benchmark held at once.
SHARD_BYTES, BLOCK_WORDS = 4 << 20, 500_000
SAMPLE = 8
ANSWER = "doc_id long, n_words long, n_hit long, item_ids array<string>, spans array<struct<start:int,stop:int>>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_KEPT).split()


@dataclass(frozen=True)
class Windows:
    """A benchmark's distinct windows: symbols by length, and the items of each."""

    vocabulary: dict[bytes, int]
    lengths: list[np.ndarray]  # one matrix (windows, words) for each length
    items: list[list[tuple[str, ...]]]

    @property
    def shortest(self) -> int:
        return min((m.shape[1] for m in self.lengths), default=1)


def windows(items: list[tuple[str | None, bytes]], size: int = 10) -> Windows:
    """Every window of ``size`` words; an item of fewer, but not none, is one window. One without an id owns none of its own."""
    vocabulary: dict[bytes, int] = {}
    by: dict[tuple[int, ...], dict[str, None]] = {}
    for item, text in items:
        w = [vocabulary.setdefault(x, len(vocabulary) + 1) for x in words(text)]
        for k in range(max(1, len(w) - size + 1) if w else 0):
            owners = by.setdefault(tuple(w[k : k + size]), {})
            if item is not None:
                owners[item] = None
    lengths = sorted({len(w) for w in by})
    chosen = [[w for w in by if len(w) == n] for n in lengths]
    return Windows(vocabulary, [np.array(c, np.int64).reshape(len(c), n) for c, n in zip(chosen, lengths, strict=True)], [[tuple(by[w]) for w in c] for c in chosen])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start of each suffix in order, by doubling the length that ranks stand for."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        changed = np.concatenate([[0], (np.diff(key[order]) != 0).astype(np.int64)])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(changed)
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class Wavelet:
    """Rank of any symbol before any place, by one bit plane for each bit of a symbol, highest first."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max()).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(symbols) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``."""
        low, high = np.zeros_like(place), place
        for level in range(self.bits):
            bit = (symbol >> (self.bits - 1 - level)) & 1
            ones, zeros = self.ones[level], self.zeros[level]
            a, b = ones[low].astype(np.int64), ones[high].astype(np.int64)
            low, high = np.where(bit, zeros + a, low - a), np.where(bit, zeros + b, high - b)
        return high - low


class FMIndex:
    """Index of a text of separators (below ``first``, each another symbol) and words (from ``first`` on)."""

    def __init__(self, text: np.ndarray, first: int):
        order = suffix_array(text)
        before = text[order - 1]  # of the text's start the last symbol, a separator
        self.first = first
        # Separators differ in the order, but one symbol stands for all of them in the transform.
        self.last = np.where(before < first, 0, before - first + 1)
        self.wavelet = Wavelet(self.last)
        folded = np.sort(np.where(text < first, 0, text - first + 1))
        self.starts = np.searchsorted(folded, np.arange(folded[-1] + 2))
        # A walk back never meets a separator: places after one are sampled, as is every SAMPLE-th.
        self.sampled = (order % SAMPLE == 0) | (self.last == 0)
        self.position = order

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of the suffixes that begin with each pattern; symbols count from 1."""
        m, n = patterns.shape
        low, high = np.zeros(m, np.int64), np.full(m, len(self.last), np.int64)
        alive = np.arange(m)
        for k in range(n - 1, -1, -1):
            c = patterns[alive, k]
            known = c < len(self.starts) - 1
            high[alive[~known]] = low[alive[~known]] = 0
            alive, c = alive[known], c[known]
            low[alive] = self.starts[c] + self.wavelet.rank(c, low[alive])
            high[alive] = self.starts[c] + self.wavelet.rank(c, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start."""
        out, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        at, left = rows.copy(), np.arange(len(rows))
        while len(left):
            there = self.sampled[at[left]]
            out[left[there]] = self.position[at[left[there]]] + steps[left[there]]
            left = left[~there]
            c = self.last[at[left]]
            at[left] = self.starts[c] + self.wavelet.rank(c, at[left])
            steps[left] += 1
        return out


def occurrences(texts: list[list[bytes]], want: Windows) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """For a shard: where its documents begin among its words, which words are hit, and each document's items."""
    begin = np.cumsum([0, *map(len, texts)])
    items: list[set[str]] = [set() for _ in texts]
    hit = np.zeros(begin[-1] + 1, np.int64)
    get = want.vocabulary.get
    # A zero before each document and after the last keeps windows within documents.
    symbols = np.zeros(begin[-1] + len(texts) + 1, np.int64)
    for k, w in enumerate(texts):
        symbols[begin[k] + k + 1 : begin[k + 1] + k + 1] = np.fromiter((get(x, 0) for x in w), np.int64, len(w))
    known = symbols > 0
    edges = np.flatnonzero(np.diff(known.astype(np.int8)))
    first, stop = edges[::2] + 1, edges[1::2] + 1
    long = stop - first >= want.shortest
    first, stop = first[long], stop[long]
    if len(first):
        # Runs of known words, a separator after each; place[i] is where symbol i of the index stands in the shard.
        sizes = stop - first
        ends = np.cumsum(sizes + 1)
        place = np.arange(ends[-1]) + np.repeat(first - (ends - sizes - 1), sizes + 1)
        text = symbols[place]
        text[ends - 1] = 0
        m = len(first)
        text = np.where(text > 0, text + m - 1, 0)
        text[ends - 1] = np.arange(m)
        index = FMIndex(text, m)
        document = np.repeat(np.arange(len(texts)), np.diff(begin))
        for patterns, owners in zip(want.lengths, want.items, strict=True):
            low, high = index.search(patterns)
            found = np.flatnonzero(low < high)
            if not len(found):
                continue
            counts = (high - low)[found]
            rows = np.arange(counts.sum()) + np.repeat(low[found] - (np.cumsum(counts) - counts), counts)
            at = place[index.locate(rows)]
            # Symbols have one zero more for each document up to here than the shard has words.
            doc = np.searchsorted(begin[:-1] + np.arange(len(texts)) + 1, at, side="right") - 1
            word = at - doc - 1
            assert (document[word] == doc).all()
            np.add.at(hit, word, 1)
            np.add.at(hit, word + patterns.shape[1], -1)
            pairs = np.unique(doc * len(patterns) + np.repeat(found, counts))
            for p in pairs.tolist():
                items[p // len(patterns)].update(owners[p % len(patterns)])
    return begin, np.cumsum(hit)[:-1] > 0, items


def spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as [start, stop)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _blocks(benchmark: DataFrame, size: int, id_col: str, text_col: str) -> tuple[int, Callable[[int], Windows]]:
    """The benchmark's windows in parts of about BLOCK_WORDS, each made on the driver when asked for.

    A benchmark of more than one part is cut into its different windows first, and these are dealt: neither a huge
    item nor one that is repeated makes a part larger.
    """
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), utf8(F.col(text_col)).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= 4 * BLOCK_WORDS:
        return 1, lambda _: windows([(r.item_id, bytes(r.text)) for r in items.collect()], size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
                w = words(text.as_py())
                starts = range(max(1, len(w) - size + 1) if w else 0)
                for first in range(0, len(starts), 10_000):
                    own = [b" ".join(w[k : k + size]) for k in starts[first : first + 10_000]]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(own), pa.string()), pa.array(own, pa.binary())], names=["item_id", "text"])

    cut = stored(items.mapInArrow(run, "item_id string, text binary").distinct(), "windows")
    parts = max(1, ceil(cut.agg(F.approx_count_distinct("text")).first()[0] / BLOCK_WORDS))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(parts)))
    return parts, lambda k: windows([(r.item_id, bytes(r.text)) for r in dealt.where(F.col("part") == k).collect()], size)


def _search(docs: DataFrame, shared: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins("decontamination")
        for shard in slices(batches, "text", SHARD_BYTES):
            texts = [words(t.as_py()) for t in shard.column("text")]
            begin, hit, items = occurrences(texts, shared.value)
            runs = [spans(hit[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    shard.column("doc_id"),
                    pa.array(np.diff(begin), pa.int64()),
                    pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                    pa.array([[{"start": a, "stop": b} for a, b in r] for r in runs], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                ],
                names=["doc_id", "n_words", "n_hit", "item_ids", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, ANSWER)


def _united(docs: DataFrame, parts: int, block: Callable[[int], Windows], hits_only: bool = False) -> DataFrame:
    """The answers of all parts to the same texts, united by doc_id, which is a row's own number here."""
    context, found = docs.sparkSession.sparkContext, []
    for k in range(parts):
        shared = context.broadcast(block(k))
        answers = _search(docs, shared)
        found.append(stored(answers.where("n_hit > 0") if hits_only else answers, "answers"))
        shared.destroy()
    every = functools.reduce(DataFrame.unionByName, found)
    merged = every.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("all")
    )
    start = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("stop"))
    folded = F.aggregate(
        "all",
        F.array(start),
        lambda acc, x: F.when(x["start"] <= F.element_at(acc, -1)["stop"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop"))))).otherwise(F.concat(acc, F.array(x))),
    )
    merged = merged.withColumn("spans", F.filter(folded, lambda x: x["start"] >= 0))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["stop"] - x["start"])
    return merged.withColumn("n_hit", n_hit).select("doc_id", "n_words", "n_hit", "item_ids", "spans")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_hit, item_ids (sorted as strings), spans of hit words [start, stop).

    Null texts have no words, and items without words no windows. An item without an id has windows, whose words are
    hit, but no name among the item_ids. Repeated rows and null document ids are answered each for itself. A benchmark
    beyond BLOCK_WORDS is searched in parts, whose answers are united by row. Empty tables give no rows, or no hits.
    Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    n, block = _blocks(benchmark, size, item_col, item_text_col)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    if n == 1:
        return _search(docs, spark.sparkContext.broadcast(block(0)))
    # Rows are numbered in a stored copy; the number travels as the id.
    numbered = stored(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    merged = _united(numbered.select(F.col("row").alias("doc_id"), "text"), n, block).withColumnRenamed("doc_id", "row")
    return numbered.select("row", "doc_id").join(merged, "row").select("doc_id", "n_words", "n_hit", "item_ids", "spans")


def cut_spans(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """A text without these runs of its words, each cut from its first word's start to its last word's end."""
    found = list(WORD.finditer(text))
    kept, last = [], 0
    for a, b in runs:
        kept.append(text[last : found[a].start()])
        last = found[b - 1].end()
    return b"".join([*kept, text[last:]])


def cut_out(text: bytes, want: Windows) -> tuple[bytes, int]:
    """A text without its removal spans, searched again until a cut leaves none; and the words removed."""
    removed = 0
    while True:
        _, hit, _ = occurrences([words(text)], want)
        runs = spans(hit)
        if not runs:
            return text, removed
        removed += sum(b - a for a, b in runs)
        text = cut_spans(text, runs)


def _cut_by_all(docs: DataFrame, parts: int, block: Callable[[int], Windows], text_col: str) -> DataFrame:
    """What cut_out does with all parts' windows at once: every round cuts the united spans of all parts.

    Only texts that were cut are searched in the next round, until no part hits. Rows are numbered in a stored copy.
    """
    row, of, new = "row", "row_cut", "row_text"
    while {row, of, new} & set(map(str.lower, docs.columns)):
        row, of, new = f"_{row}", f"_{of}", f"_{new}"
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    todo = numbered.select(F.col(row).alias("doc_id"), utf8(F.col(text_col)).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cut_spans(t.as_py(), [(s["start"], s["stop"]) for s in r.as_py()]) for t, r in zip(batch.column("text"), batch.column("spans"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "text"])

    rounds: list[DataFrame] = []
    while True:
        found = _united(todo, parts, block, hits_only=True).select("doc_id", "spans")
        todo = stored(todo.join(found, "doc_id").select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, text binary"), "cut")
        if todo.isEmpty():
            break
        rounds.append(todo.withColumn("round", F.lit(len(rounds))))
    if not rounds:
        return numbered.drop(row)
    last = functools.reduce(DataFrame.unionByName, rounds).groupBy("doc_id").agg(F.max(F.struct("round", "text")).alias("last"))
    last = last.select(F.col("doc_id").alias(of), F.col("last.text").cast("string").alias(new))
    # A text that was cut to nothing is empty, not null.
    joined = numbered.join(last, F.col(row) == F.col(of), "left")
    return joined.select(*(F.coalesce(new, F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The same rows and columns, with every window's occurrences cut out of the text.

    Where a cut brings words together that make a window, they are cut too. Null texts stay null, a text that is
    nothing but windows becomes what stood around them, and untouched texts keep every byte. A large benchmark's
    parts are all searched before each cut, so the number of parts does not change the result.
    """
    spark = docs.sparkSession
    ship(spark)
    n, block = _blocks(benchmark, size, item_col, item_text_col)
    if n > 1:
        return _cut_by_all(docs, n, block, text_col)
    shared, place = spark.sparkContext.broadcast(block(0)), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins("decontamination")
        for shard in slices(batches, text_col, SHARD_BYTES):
            texts = [(t.as_py() or "").encode() for t in shard.column(place)]
            begin, hit, _ = occurrences([words(t) for t in texts], shared.value)
            if hit.any():
                for k, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
                    if hit[a:b].any():
                        texts[k] = cut_out(texts[k], shared.value)[0]
                values = [None if old is None else t.decode() for old, t in zip(shard.column(place).to_pylist(), texts, strict=True)]
                shard = shard.set_column(place, shard.schema.field(place), pa.array(values, shard.schema.field(place).type))
            yield shard

    return docs.mapInArrow(run, docs.schema)
