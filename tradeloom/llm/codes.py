"""Vectors compressed to codebook indexes, with bounds by the norm of summed displacements.

Every part of a vector holds, for each group of its codebook's entries, a lower
bound of the distance to the entries it is not assigned to, and the round in
which that bound was true. All rounds' codebooks are retained. What an entry has
moved since a bound's round is the distance between its place then and now: the
norm of the sum of its moves, never more than the sum of their norms. A group is
searched again, exactly and in integers, only where the bound less the largest
such displacement does not exceed the distance to the part's own entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.integers import SUMS, finite, floored, lists, matrix, products, summed, sums_batch
from tradeloom.llm.runtime import Rewritten, ship, stored

#: Entries whose bounds are held as one.
GROUP = 16
#: Bounds are lowered and displacements raised by this share, which covers their rounding.
MARGIN = 1e-6
#: What a turn writes, after the vector's own columns.
STATE = "codes array<int>, before array<int>, bounds array<float>, stamps array<tinyint>, error long"
OWN = ["vec_id", "label", "x"]


def cuts(dimension: int, parts: int) -> list[tuple[int, int]]:
    """Where consecutive parts begin and end; the first ones take one more where they cannot be equal."""
    sizes = [dimension // parts + (p < dimension % parts) for p in range(parts)]
    return [(sum(sizes[:p]), sum(sizes[: p + 1])) for p in range(parts)]


def displacements(history: list[np.ndarray], group: int = GROUP) -> np.ndarray:
    """(round, group): the most that an entry of the group has moved, net, from its place in that round to the last one."""
    now = history[-1]
    starts = np.arange(0, len(now), group)
    moved = [np.sqrt(((now - then).astype(np.float64) ** 2).sum(axis=1)) for then in history]
    return np.array([np.maximum.reduceat(m, starts) for m in moved]) * (1 + MARGIN)


class PartSearch:
    """Nearest entries of one codebook for a batch of parts, after ``history`` of its rounds."""

    def __init__(self, history: list[np.ndarray], group: int = GROUP):
        self.entries, self.round, self.group = history[-1], len(history) - 1, group
        self.norms = (self.entries**2).sum(axis=1)
        self.moved = displacements(history, group)
        self.searched = 0

    def assign(self, x: np.ndarray, code: np.ndarray, bounds: np.ndarray, stamps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(codes, squared distances, bounds, stamps). The lower index of equally near entries."""
        n, groups = bounds.shape
        own = ((x - self.entries[code]) ** 2).sum(axis=1)
        reach = np.sqrt(own.astype(np.float64)) * (1 + MARGIN)
        lower = bounds.astype(np.float64) - self.moved[stamps, np.arange(groups)[None, :]]
        search = lower <= reach[:, None]
        self.searched += int(search.sum())
        norm = (x**2).sum(axis=1)
        best, index = own.copy(), code.astype(np.int64)
        none = np.iinfo(np.int64).max
        first, second, place = (np.full((n, groups), v, np.int64) for v in (none, none, -1))
        for g in range(groups):
            rows = np.flatnonzero(search[:, g])
            if not len(rows):
                continue
            part = slice(g * self.group, (g + 1) * self.group)
            far = norm[rows, None] - 2 * products(x[rows], self.entries[part].T) + self.norms[part][None, :]
            at, r = far.argmin(axis=1), np.arange(len(rows))
            first[rows, g], place[rows, g] = far[r, at], at + g * self.group
            far[r, at] = none
            second[rows, g] = far.min(axis=1)
            better = (first[rows, g] < best[rows]) | ((first[rows, g] == best[rows]) & (place[rows, g] < index[rows]))
            best[rows[better]], index[rows[better]] = first[rows[better], g], place[rows[better], g]
        # A bound leaves out the part's own entry.
        others = np.where(place == index[:, None], second, first)
        fresh = np.where(others == none, np.inf, np.sqrt(others.astype(np.float64))) * (1 - MARGIN)
        bounds, stamps = bounds.copy(), stamps.copy()
        bounds[search], stamps[search] = fresh[search].astype(np.float32), self.round
        # An entry that is left joins the bound of its group, where that was not searched.
        left = np.flatnonzero(index != code)
        left = left[~search[left, code[left] // self.group]]
        g = code[left] // self.group
        bounds[left, g] = np.minimum(lower[left, g], reach[left] * (1 - 3 * MARGIN))
        stamps[left, g] = self.round
        return index.astype(np.int32), best, bounds, stamps


def turn(state: DataFrame, history: list[list[np.ndarray]], dimension: int, group: int) -> DataFrame:
    """Every part's nearest entry in the last of its codebooks. ``history`` holds each round's codebooks by part."""
    parts = len(history[0])
    places, m = cuts(dimension, parts), len(history[0][0])
    groups = -(-m // group)
    own = ", ".join(f"{c} {state.schema[c].dataType.simpleString()}" for c in OWN)
    names = OWN + [f.split()[0] for f in STATE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [PartSearch([books[p] for books in history], group) for p in range(parts)]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = matrix(batch.column("x"), dimension)
            before = matrix(batch.column("codes"), parts)
            bounds = matrix(batch.column("bounds"), parts * groups).reshape(n, parts, groups).copy()
            stamps = matrix(batch.column("stamps"), parts * groups).reshape(n, parts, groups).copy()
            codes, error = np.empty((n, parts), np.int32), np.zeros(n, np.int64)
            for p, (a, b) in enumerate(places):
                codes[:, p], found, bounds[:, p], stamps[:, p] = searches[p].assign(x[:, a:b], np.maximum(before[:, p], 0), bounds[:, p], stamps[:, p])
                error += found
            columns = [batch.column(c) for c in OWN]
            columns += [lists(codes), batch.column("codes"), lists(bounds.reshape(n, -1)), lists(stamps.reshape(n, -1)), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return state.mapInArrow(run, f"{own}, {STATE}")


def changed_sums(state: DataFrame, entries: int, parts: int, dimension: int) -> dict[int, tuple[int, list[int]]]:
    """By how much each entry's count and sums changed, under part * entries + entry: of vectors with a part that moved."""
    places = cuts(dimension, parts)
    width = max(b - a for a, b in places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), dimension)
            now, before = matrix(batch.column("codes"), parts), matrix(batch.column("before"), parts)
            for p, (a, b) in enumerate(places):
                moved = now[:, p] != before[:, p]
                for codes, sign in ((now[moved, p], 1), (before[moved, p], -1)):
                    rows, codes = x[moved, a:b][codes >= 0], codes[codes >= 0]
                    if not len(codes):
                        continue
                    order = np.argsort(codes, kind="stable")
                    names, starts, n = np.unique(codes[order], return_index=True, return_counts=True)
                    counts[p * entries + names] += sign * n
                    if b > a:
                        totals[p * entries + names, : b - a] += sign * np.add.reduceat(rows[order], starts, axis=0)
        some = np.flatnonzero(counts.astype(bool) | totals.any(axis=1))
        yield sums_batch(some, counts[some], totals[some])

    return summed(state.where("codes != before").select("x", "codes", "before").mapInArrow(run, SUMS))


def _coded(rows: DataFrame, dimension: int, entries: int, parts: int, rounds: int, group: int) -> DataFrame:
    """(label, vec_id, code, error, codebooks_sha256) of vectors of one dimension."""
    seeds = rows.where("vec_id is not null").select("vec_id", "x").orderBy("vec_id", "x").limit(entries).collect()
    places = cuts(dimension, parts)
    first = np.array([s.x for s in seeds], np.int64).reshape(len(seeds), dimension)
    history = [[first[:, a:b] for a, b in places]]
    m = len(seeds)
    if not m:
        return rows.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256"))
    groups = -(-m // group)
    blank = rows.select(
        *OWN, F.array_repeat(F.lit(-1), parts).alias("codes"), F.array_repeat(F.lit(-1), parts).alias("before"),
        F.array_repeat(F.lit(-1.0).cast("float"), parts * groups).alias("bounds"), F.array_repeat(F.lit(0).cast("tinyint"), parts * groups).alias("stamps"),
        F.lit(0).cast("long").alias("error"),
    )
    steps = Rewritten("codes")
    state = steps.write(turn(blank, history, dimension, group))
    counts = [0] * (parts * m)
    sums: list[list[int]] = [[0] * max(b - a for a, b in places) for _ in counts]
    for _ in range(rounds):
        for g, (n, totals) in changed_sums(state, m, parts, dimension).items():
            counts[g] += n
            sums[g] = [a + b for a, b in zip(sums[g], totals, strict=True)]
        books = []
        for p, (a, b) in enumerate(places):
            old = history[-1][p]
            means = [[s // counts[p * m + e] for s in sums[p * m + e][: b - a]] if counts[p * m + e] else old[e].tolist() for e in range(m)]
            books.append(np.array(means, np.int64).reshape(old.shape))
        if all((new == old).all() for new, old in zip(books, history[-1], strict=True)):
            break  # nothing can change any more
        history.append(books)
        state = steps.write(turn(state, history, dimension, group))
    digest = hashlib.sha256(",".join(str(v) for book in history[-1] for v in book.ravel().tolist()).encode()).hexdigest()
    digits = max(2, len(f"{entries - 1:x}"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), digits, "0")), "")
    return state.select("vec_id", "label", code.alias("code"), "error", F.lit(digest).alias("codebooks_sha256"))


def compress(
    vectors: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4, scale: int = 1024, group: int = GROUP,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per vector: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold a null or non-finite component take no part. A component x becomes floor(scale * x);
    a vector is cut into consecutive parts, equal ones where its dimension can be divided. Each part's codebook starts
    as that part of the vectors with the smallest ids, of one id's vectors the one with the least components first; null
    ids seed nothing, but are coded. Each round assigns every part to its nearest entry by squared distance, the lower
    index of equally near ones, and moves each entry to the floor of its parts' mean; unused ones stay. Repeated rows
    are so many vectors; with fewer vectors than ``entries`` there are so many entries. Vectors of different dimensions
    are coded apart, with codebooks of their own; those of a dimension of which none has an id are left out. The
    label's errors are summed over all of them, null labels together. An empty table gives no rows. Components so
    large that a distance might not fit a long are an error. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    if entries > 1 << 15 or rounds > 126:
        raise ValueError("at most 32768 entries and 126 rounds")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(finite("vector"))
    coded = None
    for d in sorted(r.d for r in rows.select(F.size("vector").alias("d")).distinct().collect()):
        own = stored(rows.where(F.size("vector") == d).select("vec_id", "label", floored("vector", scale, d).alias("x")), "integers")
        one = _coded(own, d, entries, parts, rounds, group)
        coded = one if coded is None else coded.unionByName(one)
    if coded is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    # Stored sums join as a plain exchange, of which adaptive execution splits a hot label's partition.
    per_label = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "label-errors")
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
