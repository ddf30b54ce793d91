"""Near duplicates by SimHash, found by ball hashing that meets in the middle.

Two fingerprints within the radius have a 64-bit word within half the radius of
both: every fingerprint emits the variants within half the radius, equal
variants meet, and what meets is verified. An odd radius needs the larger half
on one side only, and two fingerprints at an odd distance differ in the parity
of their bits, so the even ones take the larger half.

Variants are shuffled by their leading bits. A fingerprint is then sent once for
each value of these bits that its ball reaches, and its variants are made where
they meet: most of them keep the leading bits. The number of leading bits grows
with the logarithm of the fingerprints. A block that holds too many variants is
dealt again by further bits; at 64 bits it is one variant.

Of what meets at a variant, a fingerprint in the smaller half of its own radius
is within the radius of all others, so the least of these links with each and no
pairs need be listed. Where there is none, the pairs that link meet elsewhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import ceil, comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.components import components
from tradeloom.llm.runtime import ship, slices, stored, utf8

WIDTH, SEED = 64, 42
#: Bytes of text that a worker splits at a time.
PIECE_BYTES = 1 << 20
#: Variants that a block holds on average, and at most before it is dealt again by so many further bits.
BLOCK_VARIANTS, HOT_VARIANTS, FURTHER_BITS = 1_000_000, 4_000_000, 4
_SPACE = re.compile(rb"[ \t-\r]")


def shingle_hashes(text: bytes, size: int, piece_bytes: int = PIECE_BYTES) -> Iterator[np.ndarray]:
    """XXH64 of a text's shingles, repeats included, in pieces. ``bytes`` lower-cases A-Z alone and splits at the six ASCII spaces."""
    at, held, any_yet = 0, [], False
    while at < len(text):
        cut = _SPACE.search(text, at + piece_bytes)
        stop = cut.start() if cut else len(text)
        words = held + text[at:stop].lower().split()
        at = stop
        if len(words) < size:
            held = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) for w in words]) + np.arange(len(words))
        starts = [0, *(ends[: len(words) - size] + 1).tolist()]
        spans = zip(starts, ends[size - 1 :].tolist(), strict=True)
        yield np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))
        any_yet, held = True, words[len(words) - size + 1 :]
    if held and not any_yet:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes, size: int, piece_bytes: int = PIECE_BYTES) -> int:
    """A bit is 1 if set in over half the shingles' hashes; 0 for a text without words. Signed, as Spark's long."""
    counts, n = np.zeros(WIDTH, np.int64), 0
    for hashes in shingle_hashes(text, size, piece_bytes):
        n += len(hashes)
        for k in range(0, len(hashes), 1 << 16):
            counts += np.unpackbits(hashes[k : k + (1 << 16), None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, fp) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE_BYTES):
            found = [fingerprint(t.as_py(), size) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return docs.select("doc_id", utf8(F.col("text")).alias("text")).mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=256)
def flips(bits: int, most: int) -> np.ndarray:
    """Words with at most ``most`` of the last ``bits`` bits set."""
    return np.array([sum(1 << b for b in chosen) for k in range(most + 1) for chosen in combinations(range(bits), k)], np.uint64)


def ball(bits: int, most: int) -> int:
    """How many words ``flips`` has."""
    return sum(comb(bits, k) for k in range(most + 1))


def _flipped(bits: int, most: int) -> Column:
    """The (flips, how many of them) of ``bits`` bits, as an array."""
    return F.array(*[F.struct(F.lit(int(w)).cast("long").alias("mask"), F.lit(int(w).bit_count()).alias("used")) for w in flips(bits, most)])


def dealt(rows: DataFrame, bits: int, more: int, radius: int) -> DataFrame:
    """(block, fp, left) by ``more`` further leading bits of the variants; ``left`` flips may still be made below them."""
    if not more:
        return rows
    below = F.shiftrightunsigned("fp", WIDTH - bits - more).bitwiseAND(F.lit((1 << more) - 1).cast("long"))
    # As many flips as any ball has; a fingerprint takes those that it has left.
    each = rows.withColumn("f", F.explode(_flipped(more, min(more, (radius + 1) // 2)))).where("f.used <= left")
    upper = F.shiftleft("block", more) if bits else F.lit(0).cast("long")
    return each.select(upper.bitwiseOR(below.bitwiseXOR(F.col("f.mask"))).alias("block"), "fp", (F.col("left") - F.col("f.used")).cast("int").alias("left"))


def met(block: int, fp: np.ndarray, left: np.ndarray, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, hub) of what meets at the variants of a block."""
    rest, near = WIDTH - bits, radius // 2
    low = np.uint64((1 << rest) - 1)
    upper = np.uint64((block << rest) & (1 << WIDTH) - 1)
    words = fp.view(np.uint64)
    variants, owners = [], []
    for most in np.unique(left).tolist():
        own = np.flatnonzero(left == most)
        masks = flips(rest, most)
        variants.append((((words[own] & low) | upper)[:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(own, len(masks)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant)
    variant = variant[order]
    same = variant[1:] == variant[:-1]
    several = np.r_[same, False] | np.r_[False, same]
    variant, owner = variant[several], owner[order[several]]
    if not len(variant):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, variant[1:] != variant[:-1]])
    inner = np.bitwise_count(words[owner] ^ variant) <= near
    none = np.iinfo(np.int64).max
    hubs = np.minimum.reduceat(np.where(inner, fp[owner], none), starts)
    has = np.logical_or.reduceat(inner, starts)
    sizes = np.diff(np.r_[starts, len(variant)])
    u, v, linked = fp[owner], np.repeat(hubs, sizes), np.repeat(has, sizes)
    linked &= (u != v) & (np.bitwise_count((u ^ v).view(np.uint64)) <= radius)
    pairs = np.unique(np.stack([u[linked], v[linked]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(fps: DataFrame, n: int, radius: int = 3, block: int = BLOCK_VARIANTS, hot: int = HOT_VARIANTS) -> DataFrame:
    """Links (u, v) that connect all of ``n`` different fingerprints ``fp`` within the radius of each other."""

    def linked(rows: DataFrame, bits: int) -> DataFrame:
        def run(part: pa.Table) -> pa.Table:
            u, v = met(part["block"][0].as_py(), part["fp"].to_numpy(), part["left"].to_numpy(), bits, radius)
            return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

        return rows.groupBy("block").applyInArrow(run, "u long, v long")

    even = F.bit_count("fp") % 2 == 0
    reach = F.when(even, (radius + 1) // 2).otherwise(radius // 2)
    rows = fps.select(F.lit(0).cast("long").alias("block"), "fp", reach.cast("int").alias("left"))
    bits = min(WIDTH, max(0, ceil(log2(max(1, n) * ball(WIDTH, (radius + 1) // 2) / 2 / block))))
    rows, found = dealt(rows, 0, bits, radius), []
    while True:
        held = F.element_at(F.array(*[F.lit(ball(WIDTH - bits, k)) for k in range((radius + 1) // 2 + 1)]), F.col("left") + 1)
        heavy = stored(rows.groupBy("block").agg(F.sum(held).alias("variants")).where(F.col("variants") > hot).select("block"), "hot-blocks")
        if bits == WIDTH or heavy.isEmpty():
            found.append(stored(linked(rows, bits), "links"))
            break
        found.append(stored(linked(rows.join(heavy, "block", "left_anti"), bits), "links"))
        more = min(FURTHER_BITS, WIDTH - bits)
        rows = stored(dealt(rows.join(heavy, "block", "left_semi").select("block", "fp", "left"), bits, more, radius), "dealt-again")
        bits += more
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK_VARIANTS, hot: int = HOT_VARIANTS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 lowercase hex digits), component_id (the smallest doc_id reachable).

    Words are runs without ASCII white space, with A-Z lowered; shingles are ``size`` words, repeats included; fewer
    words are one shingle. A null or empty text, or one without words, has the fingerprint zero, which links like any
    other. Documents link where their fingerprints differ in at most ``radius`` bits. Rows of one id are one document,
    linked with whatever any of them is linked with. A row with a null id links others, but never names a component:
    its component_id is null if it reaches no id. Texts are read whole, in pieces. An empty table gives no rows. Other
    columns, whatever their names, are not read.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = stored(fingerprints(docs, size), "fingerprints")
    # A fingerprint that many rows hold is one row from here on.
    fps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = links(fps.select("fp"), fps.count(), radius, block, hot)
    several = prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("v"), F.max("fp").alias("most")).where("v != most")
    of_one_id = prints.join(several, "doc_id").where("fp != v").select(F.col("fp").alias("u"), "v")
    found = components(found.unionByName(of_one_id))
    named = fps.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    named = stored(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # Stored aggregates join as plain exchanges, of which adaptive execution splits a hot fingerprint's partition.
    named = stored(named.join(least, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
