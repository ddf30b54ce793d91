"""Best-fit packing with certified bin counts.

Documents are tokenized once; only the lengths of their pieces take part in the
packing. Pieces are dealt at random over partitions of bounded size, and each
packs its own by best-fit decreasing. Dual-feasible functions give a lower bound
of a partition's bins: where the count meets it, no packing of these pieces is
shorter, and the partition is done. Partitions with a gap hand the pieces of
their unfilled bins to a common pool that is dealt and packed again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.bytebpe import forget_encoders, text_encoder
from tradeloom.llm.runtime import begins, ship, stored

TOKENIZER = "byte_bpe_50k.json"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, certified boolean"


def cut(docs: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer_name: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32. A document is its ids and then ``end_id``.

    Longer documents are cut so that the first piece takes what does not fill a whole one.
    """
    ship(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins("packing", forget_encoders)
        encode, end = text_encoder(tokenizer_name), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), ([], [], [], [], [])
            for doc, text in zip(ids, batch.column(1), strict=True):
                data = encode(text.as_py() or "") + end
                n = len(data) // 4
                start = 0
                stop = n % capacity or min(n, capacity)
                piece = 0
                while start < n:
                    out[0].append(doc)
                    out[1].append(piece)
                    out[2].append(start)
                    out[3].append(stop - start)
                    out[4].append(zlib.crc32(data[4 * start : 4 * stop]))
                    start, stop, piece = stop, stop + capacity, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(pieces, PIECES)


def lower_bound(counts: np.ndarray) -> int:
    """Bins that pieces need at least; ``counts[s]`` pieces have size s, and the capacity is its last index.

    The largest of three kinds of bound by dual-feasible functions: sizes as they are; sizes over capacity - k
    raised to the capacity and those under k dropped; sizes rounded to k-ths of the capacity.
    """
    cap = len(counts) - 1
    size = np.arange(cap + 1)
    best = ceil(int((counts * size).sum()) / cap)
    for k in range(1, cap // 2 + 1):
        large, mid = counts[cap - k + 1 :].sum(), counts[k : cap - k + 1] @ size[k : cap - k + 1]
        best = max(best, int(large) + ceil(int(mid) / cap))
    for k in range(1, 64):
        # An exact multiple of cap / (k + 1) keeps its value; others are rounded down to k-ths. In units of 1 / (k (k + 1) cap).
        scaled = (k + 1) * size
        value = np.where(scaled % cap == 0, k * scaled, (k + 1) * (scaled // cap) * cap)
        best = max(best, ceil(int(counts @ value) / (k * (k + 1) * cap)))
    return best


def best_fit_decreasing(counts: np.ndarray) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Placements (size, bin, how many) in order of falling size, and the fill of each bin.

    The fullest bin that takes a size also takes the next pieces of that size, until it is full for them; so
    equal sizes are placed in groups.
    """
    cap = len(counts) - 1
    room: list[list[int]] = [[] for _ in range(cap + 1)]
    placed, left_in = [], []
    for size in range(cap, 0, -1):
        left = int(counts[size])
        if not left:
            continue
        for r in range(size, cap + 1):
            while left and room[r]:
                b = room[r].pop()
                n = min(left, r // size)
                placed.append((size, b, n))
                left -= n
                left_in[b] = r - n * size
                room[left_in[b]].append(b)
            if not left:
                break
        while left:
            n = min(left, cap // size)
            placed.append((size, len(left_in), n))
            left -= n
            left_in.append(cap - n * size)
            room[left_in[-1]].append(len(left_in) - 1)
    return placed, [cap - r for r in left_in]


def _pack(part: pd.DataFrame, capacity: int, first: int) -> pd.DataFrame:
    """One partition: its bins, and whether their count is certified. ``again`` marks pieces of unfilled bins in a gap."""
    part = part.sort_values(["length", "rid"], ascending=[False, True], kind="stable").reset_index(drop=True)
    counts = np.bincount(part["length"], minlength=capacity + 1)
    placed, fill = best_fit_decreasing(counts)
    bins = np.repeat([b for _, b, _ in placed], [n for _, _, n in placed])
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(part["length"].to_numpy()[order])
    starts = ends - part["length"].to_numpy()[order]
    opened = np.searchsorted(bins[order], np.arange(len(fill)))
    offset = np.empty(len(part), np.int64)
    offset[order] = starts - np.repeat(starts[opened], np.bincount(bins, minlength=len(fill)))
    certified = len(fill) == lower_bound(counts)
    part["sequence_id"] = (first + part["part"].astype("int64")) * 2**32 + bins
    part["offset"] = offset
    part["certified"] = certified
    part["again"] = False if certified else np.asarray(fill)[bins] < capacity
    return part


def _packer(capacity: int, first: int, columns: list[str]):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        return _pack(part, capacity, first)[columns]

    return run


def pack(pieces: DataFrame, capacity: int = 1024, partition_pieces: int = 100_000, rounds: int = 4) -> DataFrame:
    """Assign every piece (doc_id, piece, start, length, ids_crc32) a sequence_id and an offset.

    Pieces of the full capacity are sequences of their own. Rounds end when every partition is certified or the
    pool was one partition already; ``rounds`` bounds the exchanges. ``certified`` tells whether the bound was met
    where the piece was packed last. Repeated rows and null ids are packed like any others: a row's number in the
    stored table, not its id, decides its partition. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    ship(spark)
    pieces = stored(pieces.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("rid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified")
    )
    done, pool, first = [whole], pieces.where(F.col("length") < capacity), 0
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, rid long, part int, sequence_id long, offset long, certified boolean, again boolean"
    names = [f.split()[0] for f in schema.split(", ")]
    for turn in range(rounds):
        n = pool.count()
        if not n:
            break
        parts = ceil(n / partition_pieces)
        last = parts == 1 or turn == rounds - 1
        dealt = pool.select(*names[:6], F.pmod(F.xxhash64(F.col("rid"), F.lit(turn)), F.lit(parts)).cast("int").alias("part"))
        packed = dealt.groupBy("part").applyInPandas(_packer(capacity, first, names), schema)
        out = [n.split()[0] for n in PACKED.split(", ")]
        if last:
            done.append(packed.select(*out))
            break
        packed = stored(packed, "packed")
        done.append(packed.where(~F.col("again")).select(*out))
        pool, first = packed.where("again").select(*names[:6]), first + parts
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer_name: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack whole documents. A null text is empty: one piece that holds ``end_id`` alone."""
    return pack(cut(docs, capacity, end_id, tokenizer_name, id_col, text_col), capacity)
