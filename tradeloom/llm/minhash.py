"""Near duplicates: universal hash minima, banding, signature verification, full sets, components.

Equal sets form classes; only a class's representative goes on. Each of its 32
band hashes puts it in a bucket. Candidate pairs are first those of a bucket's
members with its smallest member, so a bucket of n texts gives n - 1 pairs and
not n squared. Buckets that still hold more than one component after these
links are searched in blocks, and only pairs between components whose
signatures come near the similarity are compared. Every link is confirmed on
the full shingle sets.

A pair at similarity 0.8 is missed by all 32 bands of 5 minima with probability
3e-6, and by the signature filter, five standard deviations below, with 3e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.components import components
from tradeloom.llm.runtime import begins, ship, slices, stored, utf8

BANDS, BAND_ROWS = 32, 5
MINIMA = BANDS * BAND_ROWS
_draw = np.random.default_rng(20)
# x -> (a x + b mod 2^64) / 2^32, a odd: a universal family.
MULTIPLIERS = _draw.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _draw.integers(0, 2**63, MINIMA, dtype=np.uint64)
MEMO_WORDS = 100_000
#: Bytes of text whose sets a worker holds at a time.
SLICE_BYTES = 4 << 20
#: Members of a bucket, and shingles of these, that one task compares with as many others.
BLOCK, BLOCK_SHINGLES = 2_000, 4_000_000
#: Members that are verified against one copy of their hub's set.
HUB_MEMBERS = 4_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = WordHashes()


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. ``bytes`` lower-cases A-Z alone and splits at the six ASCII spaces."""
    begins("shingles", _words.clear)
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    if n < size:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64)
    mixed = h[: n - size + 1].copy()
    for k in range(1, size):
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed += h[k : n - size + 1 + k]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minima(sets: list[np.ndarray], block: int = 1 << 15) -> np.ndarray:
    """The signature of each set, none of them empty; sets are taken together in blocks that fit the cache."""
    out = np.full((len(sets), MINIMA), 0xFFFFFFFF, np.uint32)
    parts = [(i, s[k : k + block]) for i, s in enumerate(sets) for k in range(0, len(s), block)]
    start = 0
    while start < len(parts):
        stop, held = start, 0
        while stop < len(parts) and (stop == start or held + len(parts[stop][1]) <= block):
            held += len(parts[stop][1])
            stop += 1
        values = np.concatenate([p for _, p in parts[start:stop]])
        at = np.cumsum([0, *(len(p) for _, p in parts[start : stop - 1])])
        owner = [i for i, _ in parts[start:stop]]
        for k in range(MINIMA):
            low = np.minimum.reduceat((values * MULTIPLIERS[k] + ADDENDS[k]) >> np.uint64(32), at).astype(np.uint32)
            np.minimum.at(out[:, k], owner, low) if len(set(owner)) < len(owner) else out.__setitem__((owner, k), np.minimum(out[owner, k], low))
        start = stop
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One hash for each band, different bands apart."""
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15), len(signatures), 0)
    for row in range(BAND_ROWS):
        keys ^= keys >> np.uint64(31)
        keys *= np.uint64(0xBF58476D1CE4E5B9)
        keys += signatures[:, row::BAND_ROWS].astype(np.uint64)
    keys ^= keys >> np.uint64(30)
    keys *= np.uint64(0x94D049BB133111EB)
    return (keys ^ (keys >> np.uint64(31))).view(np.int64)


FINGERPRINT = "doc_id long, n_shingles long, set_key binary, bands array<long>, bytes binary"


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """Per row: id, set size, digest of the set, band keys, and a byte of each minimum. Empty sets have no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            sets = [shingle_set(t.as_py(), size) for t in batch.column(1)]
            full = [i for i, s in enumerate(sets) if len(s)]
            signatures = minima([sets[i] for i in full])
            bands, low = band_keys(signatures) if full else [], signatures.astype(np.uint8)
            place = {i: k for k, i in enumerate(full)}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([bands[place[i]] if i in place else None for i in range(len(sets))], pa.list_(pa.int64())),
                    pa.array([low[place[i]].tobytes() if i in place else None for i in range(len(sets))], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_key", "bands", "bytes"],
            )

    return docs.select("doc_id", utf8(F.col("text")).alias("text")).mapInArrow(run, FINGERPRINT)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, MINIMA)


def _alike(pairs: DataFrame, least: float) -> DataFrame:
    """Of (u, v, a, b), the pairs whose signatures a and b have at least this share of equal bytes, with the share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = (_signatures(batch.column("a")) == _signatures(batch.column("b"))).mean(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(share)], names=["u", "v", "share"]).filter(pa.array(share >= least))

    return pairs.mapInArrow(run, "u long, v long, share double")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents with these ids, stored.

    Always a sort-merge join: the ids can be any share of the documents, and the plan is the same at every size.
    """
    wanted = ids.distinct().hint("merge")
    return stored(docs.select(F.col("doc_id").alias("id"), utf8(F.col("text")).alias("text")).join(wanted, "id", "left_semi"), "texts")


def verify(texts: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of pairs (u, v), those whose full sets have 100 intersection >= percent union. ``texts`` has those of both.

    The texts of a pair's u go to its v, in groups of bounded size, each with its own copy of v's text; a group is
    read as a stream that begins with v.
    """
    pairs = stored(pairs, "pairs")
    sizes = stored(pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / F.lit(HUB_MEMBERS)).cast("int").alias("groups")), "hubs")
    members = pairs.join(sizes, "v").select(F.col("u").alias("id"), F.col("v").alias("hub"), F.pmod(F.xxhash64("u"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("member"))
    hubs = sizes.select(F.col("v").alias("id"), F.col("v").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("member"))
    wanted = stored(members.unionByName(hubs), "wanted")
    grouped = texts.join(wanted, "id").repartition("hub", "part").sortWithinPartitions("hub", "part", "member").select("hub", "part", "member", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, hub_sets = None, []
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in ("hub", "part", "member", "id")), strict=True)
            out = ([], [])
            for (hub, part, member, doc), text in zip(keys, batch.column("text"), strict=True):
                if (hub, part) != group:
                    group, hub_sets = (hub, part), []
                own = shingle_set(text.as_py(), size)
                if not member:
                    hub_sets.append(own)
                    continue
                for other in hub_sets:
                    low, high = sorted((len(own), len(other)))
                    if 100 * low < percent * high:
                        continue
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(other) - common):
                        out[0].append(doc)
                        out[1].append(hub)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["u", "v"])

    return stored(grouped.mapInArrow(run, "u long, v long").distinct(), "links")


def _near(part: pa.Table, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Within a block pair of one bucket: each member with those of other components whose signatures come near enough.

    A pair that shares several buckets is met in that of its first band alone.
    """
    signed = _signatures(part["bytes"])
    bands = part["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    rep, comp, mine = (part[c].to_numpy() for c in ("rep", "comp", "mine"))
    i, j, pos = (part[c][0].as_py() for c in ("i", "j", "pos"))
    left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
    for a in left:
        others = right[(comp[right] != comp[a]) & ((i != j) | (rep[right] < rep[a]))]
        others = others[(signed[others] == signed[a]).mean(axis=1) >= least]
        others = others[(bands[others] == bands[a]).argmax(axis=1) == pos]
        if len(others):
            yield a, others


def _with_partners(least: float):
    """The members that have a near enough partner in this block pair: no more rows than members."""

    def run(part: pa.Table) -> pa.Table:
        wanted = np.zeros(part.num_rows, bool)
        for a, others in _near(part, least):
            wanted[a] = wanted[others] = True
        return part.filter(pa.array(wanted))

    return run


def _links_within(least: float, size: int, percent: int):
    """Links between components within a block pair, on full sets; of links that join the same components, one."""

    def run(part: pa.Table) -> pa.Table:
        sets = [shingle_set(t.as_py(), size) for t in part["text"]]
        rep, comp = part["rep"].to_numpy(), part["comp"].to_numpy()
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        found = []
        for a, others in _near(part, least):
            others = [b for b in others.tolist() if find(comp[b]) != find(comp[a])]
            if not others:
                continue
            own, sizes = sets[a], np.array([len(sets[b]) for b in others])
            values = np.concatenate([sets[b] for b in others])
            at = np.minimum(np.searchsorted(own, values), len(own) - 1)
            common = np.add.reduceat((own[at] == values).astype(np.int64), np.cumsum([0, *sizes[:-1]]))
            for b, linked in zip(others, 100 * common >= percent * (len(own) + sizes - common), strict=True):
                if linked and find(comp[b]) != find(comp[a]):
                    root[find(comp[b])] = find(comp[a])
                    found.append((max(rep[a], rep[b]), min(rep[a], rep[b])))
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, with A-Z lowered; shingles are ``size`` words; documents are linked
    where 100 intersection >= ``percent`` union. A text of fewer words is one shingle. A null or empty text, or one
    without words, is linked with nothing. A null id takes no part: its component is null, and it is kept. Rows of
    one id are one document, linked with whatever any of them is linked with. Other columns are not read.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = stored(fingerprints(docs, size), "fingerprints")
    part = prints.where("n_shingles > 0 and doc_id is not null")
    # Stored aggregates join as plain exchanges, of which adaptive execution splits a hot key's partition.
    classes = stored(part.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    members = stored(part.select("doc_id", "n_shingles", "set_key").join(classes, "set_key").select("doc_id", "n_shingles", "rep"), "members")
    heads = members.where("doc_id = rep").select("rep").distinct()
    reps = stored(part.select("doc_id", "n_shingles", "bands", "bytes").join(heads, F.col("doc_id") == F.col("rep")).drop("doc_id").dropDuplicates(["rep", "bands"]), "representatives")

    banded = reps.select("rep", "n_shingles", F.posexplode("bands").alias("pos", "band"))
    buckets = stored(banded.groupBy("band").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    in_bucket = stored(banded.join(buckets, "band").select("band", "pos", "rep", "n_shingles", "hub", "n"), "bucket-members")
    least = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / MINIMA) ** 0.5

    signed = reps.select("rep", "bytes")
    candidates = in_bucket.where("rep != hub").select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct()
    candidates = candidates.join(signed.select(F.col("rep").alias("u"), F.col("bytes").alias("a")), "u").join(signed.select(F.col("rep").alias("v"), F.col("bytes").alias("b")), "v")
    candidates = stored(_alike(candidates.select("u", "v", "a", "b"), least), "candidates")
    texts = texts_of(docs, candidates.select(F.explode(F.array("u", "v")).alias("id")))

    # The sets of one id are one document, whether or not any of them is like another.
    several = members.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("most")).where("v != most").drop("most")
    of_one_id = stored(members.join(several, "doc_id").where("rep != v").select(F.col("rep").alias("u"), "v").distinct(), "one-id")

    # First each text's most alike hub; then the other hubs that are still apart from it; then the rest of the buckets.
    nearest = candidates.groupBy("u").agg(F.max_by("v", F.struct("share", -F.col("v"))).alias("v"))
    links = [of_one_id, verify(texts, nearest, size, percent)]
    found = components(_united(links))
    tried = nearest
    apart = _apart(candidates.select("u", "v"), found).join(tried, ["u", "v"], "left_anti")
    apart = stored(apart, "apart")
    if not apart.isEmpty():
        links.append(verify(texts, apart, size, percent))
        found = components(_united(links))

    named = in_bucket.where("n > 2").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    weight = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum("n_shingles") / F.lit(BLOCK_SHINGLES))).cast("int").alias("blocks")
    mixed = named.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), weight).where("low != high")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = named.join(mixed, "band").select("band", "pos", "rep", "comp", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("mine"), other)
    placed = placed.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("other").join(reps.select("rep", "bands", "bytes"), "rep")
    schema = "band long, pos int, rep long, comp long, mine int, i int, j int, bands array<long>, bytes binary"
    placed = placed.select(*[f.split()[0] for f in schema.split(", ")])
    rest = stored(placed.groupBy("band", "i", "j").applyInArrow(_with_partners(least), schema), "rest")
    if not rest.isEmpty():
        texts = texts_of(docs, rest.select(F.col("rep").alias("id"))).withColumnRenamed("id", "rep")
        links.append(stored(rest.join(texts, "rep").groupBy("band", "i", "j").applyInArrow(_links_within(least, size, percent), "u long, v long"), "links"))
        found = components(_united(links))

    linked = members.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = prints.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of one document of each group of near duplicates: that with the smallest id.

    Of rows that share that id, the one stays whose columns, as JSON, have the least SHA-256, so a task that is run
    again keeps the same; of equal rows one stays. Rows without an id are kept. Columns may have any names. An empty
    table gives no rows.
    """
    kept, place = "kept", "place"
    while {kept, place} & set(map(str.lower, docs.columns)):
        kept, place = f"_{kept}", f"_{place}"
    ids = near_duplicates(docs, size, percent, id_col, text_col).where("kept and doc_id is not null").select(F.col("doc_id").alias(kept)).distinct()
    held = docs.join(ids, F.col(f"`{id_col}`").cast("long") == F.col(kept))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    least = Window.partitionBy(kept).orderBy(F.sha2(F.to_json(F.struct(*columns)), 256))
    one = held.withColumn(place, F.row_number().over(least)).where(F.col(place) == 1).select(*columns)
    return one.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))


def _united(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    left = found.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    right = found.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    return pairs.join(left, "u", "left").join(right, "v", "left").where(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v")
