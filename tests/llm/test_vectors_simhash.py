"""Centroid clustering, vector codes and SimHash against plain Python."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
import xxhash

from tradeloom.llm import centroids, codes, simhash
from tradeloom.llm.integers import products

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, label="int"):
    """Rows (vec_id, embedding, label) beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "c", 1) for r in rows], f"vec_id long, embedding array<double>, label {label}, cluster string, x int")


def drawn(n, dimension, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(6, dimension))
    return [(heads[i % 6] + spread * rng.normal(size=dimension)).tolist() for i in range(n)]


def is_usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def nearest(x, book):
    return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(book))


def moved(book, owners, xs):
    out = []
    for i, c in enumerate(book):
        own = [x for o, x in zip(owners, xs, strict=True) if o == i]
        out.append([sum(col) // len(own) for col in zip(*own, strict=True)] if own else c)
    return out


def plain_clusters(rows, k, rounds, scale, dimension):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in rows if is_usable(v) and len(v) == dimension]
    seeds = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), i, x) for i, x in kept if i is not None)[:k]
    book = [x for _, _, x in seeds]
    for _ in range(rounds):
        book = moved(book, [nearest(x, book)[1] for _, x in kept], [x for _, x in kept])
    found = [(i, *nearest(x, book)) for i, x in kept]
    total = sum(d for _, d, _ in found)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in book]
    return sorted(((i, c, d, sum(e for _, e, o in found if o == c), total, digests[c]) for i, d, c in found), key=str)


AWKWARD = [(900, None, 1), (901, [0.5] * 7 + [None], 1), (902, [NAN] + [0.5] * 7, 2), (903, [INF] * 8, 2), (904, [], 1), (905, [0.25] * 5, None)]


@pytest.mark.parametrize("k,rounds", [(5, 3), (40, 2), (3, 0)])
def test_clusters_equal_plain_rounds(spark, k, rounds):
    own = drawn(30, 8, 1)
    rows = [(i, v, i % 3) for i, v in enumerate(own)] + AWKWARD
    # Repeated rows, one id with two vectors, equal vectors under two ids, no id, all zero.
    rows += [(3, own[3], 0), (4, own[5], 1), (50, own[7], 1), (None, own[8], 2), (51, [0.0] * 8, 1), (52, [-0.001] * 8, None)]
    got = centroids.cluster(vectors(spark, rows), k, rounds, 256, 8).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_clusters(rows, k, rounds, 256, 8)


def test_clusters_of_empty_and_small_tables(spark):
    empty = centroids.cluster(vectors(spark, []), dimension=8)
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0
    assert centroids.cluster(vectors(spark, AWKWARD), dimension=8).count() == 0
    one = centroids.cluster(vectors(spark, [(7, [0.5] * 8, 1)]), dimension=8).first()
    assert (one.vec_id, one.cluster, one.distance, one.inertia) == (7, 0, 0, 0)


def test_products_follow_changed_components():
    rng = np.random.default_rng(5)
    for most in (300, 1 << 28):  # in doubles, and in integers beyond their exact range
        x, old, new = rng.integers(-most, most, (50, 6)), rng.integers(-most, most, (4, 6)), rng.integers(-most, most, (4, 6))
        new[1] = old[1]
        new[2, :4] = old[2, :4]
        assert (products(x, old.T) == x @ old.T).all()
        assert (centroids.moved_products(x @ old.T, x, new - old) == x @ new.T).all()


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        centroids.cluster(vectors(spark, [(1, [1e12] * 8, 1)]), dimension=8).collect()


def plain_codes(rows, entries, rounds, scale, parts=4):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if is_usable(v)]
    found = []
    for d in sorted({len(x) for _, x, _ in kept}):
        own = [(i, x, label) for i, x, label in kept if len(x) == d]
        places = codes.cuts(d, parts)
        seeds = [x for _, x in sorted((i, x) for i, x, _ in own if i is not None)[:entries]]
        if not seeds:
            continue
        books = [[s[a:b] for s in seeds] for a, b in places]
        for _ in range(rounds):
            books = [moved(book, [nearest(x[a:b], book)[1] for _, x, _ in own], [x[a:b] for _, x, _ in own]) if b > a else book for (a, b), book in zip(places, books, strict=True)]
        digest = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
        for i, x, label in own:
            near = [nearest(x[a:b], book) for (a, b), book in zip(places, books, strict=True)]
            found.append((i, label, "".join(f"{e:02x}" for _, e in near), sum(e for e, _ in near), digest))
    sums = {}
    for _, label, _, error, _ in found:
        sums[label] = sums.get(label, 0) + error
    return sorted(((i, code, error, sums[label], digest) for i, label, code, error, digest in found), key=str)


@pytest.mark.parametrize("entries,rounds,group", [(16, 4, 4), (7, 2, 3), (256, 3, 16), (1, 2, 16)])
def test_codes_equal_plain_rounds(spark, entries, rounds, group):
    own = drawn(60, 8, 2, 0.3)
    rows = [(i, v, i % 3 or None) for i, v in enumerate(own)] + AWKWARD
    rows += [(3, own[3], 0), (4, own[5], 1), (70, own[7], 1), (None, own[8], 2), (71, [0.0] * 8, 1), (72, [-0.001] * 8, None)]
    got = codes.compress(vectors(spark, rows), entries, rounds=rounds, group=group).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_codes(rows, entries, rounds, 1024)


def test_codes_of_empty_tables_and_text_labels(spark):
    empty = codes.compress(vectors(spark, []))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    assert codes.compress(vectors(spark, AWKWARD[:4])).count() == 0
    rows = [(1, [0.5] * 8, "a"), (2, [0.25] * 8, None), (3, [0.5] * 8, "a"), (None, [0.5] * 4, "b")]
    got = codes.compress(vectors(spark, rows, "string"), rounds=1).collect()
    # The only vector of dimension 4 has no id, so that dimension has no codebook.
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == [(1, "00000000", 0, 0), (2, "01010101", 0, 0), (3, "00000000", 0, 0)]


def test_bounds_spare_searches_and_lose_nothing():
    rng = np.random.default_rng(3)
    heads = rng.integers(-2000, 2000, (64, 4))
    x = heads[rng.integers(0, 64, 3000)] + rng.integers(-300, 300, (3000, 4))
    history = [x[:64].copy()]
    n, groups = len(x), 8
    code, bounds, stamps = np.zeros(n, np.int32), np.full((n, groups), -1, np.float32), np.zeros((n, groups), np.int8)
    searched = []
    for _ in range(5):
        search = codes.PartSearch(history, 8)
        code, best, bounds, stamps = search.assign(x, code, bounds, stamps)
        exact = ((x[:, None, :] - history[-1][None]) ** 2).sum(axis=2)
        assert (code == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
        searched.append(search.searched)
        history.append(np.array([x[code == e].sum(axis=0) // (code == e).sum() if (code == e).any() else history[-1][e] for e in range(64)]))
    assert searched[0] == n * groups and 0 < searched[-1] < searched[1] < n * groups / 2


def test_net_displacement_is_no_more_than_the_accumulated_drift():
    there = np.array([[0, 0], [10, 0]])
    history = [there, there + 5, there + 1, there]
    net = codes.displacements(history, 1)
    steps = [np.sqrt(((b - a) ** 2).sum(axis=1)) for a, b in zip(history, history[1:], strict=False)]
    for r in range(3):
        assert (net[r] <= sum(steps[r:]) + 1e-4).all()
    assert net[0].max() == 0  # back where it was, while the drift is not


def plain_print(text, size):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_simhash(rows, size=3, radius=3):
    prints = [plain_print(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius or (rows[a][0] is not None and rows[a][0] == rows[b][0]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [j for m, (j, _) in enumerate(rows) if find(m) == find(k) and j is not None]
        out.append((i, f"{prints[k]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(9)
    names = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(60):
        words = rng.choice(names, rng.integers(30, 300)).tolist()
        rows.append((10 * i, " ".join(words)))
        for j in range(1, 4):  # near copies, one word changed each
            near = list(words)
            near[int(rng.integers(0, len(near)))] = "other"
            rows.append((10 * i + j, "\t".join(near).upper()))
    rows += [(1001, None), (1002, ""), (1003, " \n\x0b"), (1004, "one"), (1005, "ONE"), (1006, "one two"), (1007, "one two three")]
    # A row without id between others, repeated rows, one id with the texts of two.
    rows += [(None, rows[0][1]), (None, "nothing like it here at all"), rows[4], rows[4], (1010, rows[8][1]), (1010, rows[12][1])]
    rows += [(1011, " ".join(rng.choice(names, 40_000).tolist()))]
    return rows


@pytest.mark.parametrize("block,hot", [(1_000_000, 4_000_000), (20_000, 60_000)])
def test_simhash_equals_all_pairs(spark, texts, block, hot):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in texts], "doc_id long, text string, fp string, block int, component_id int")
    got = simhash.near_duplicates(docs, block=block, hot=hot)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_simhash(texts)


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pieces_of_a_text_do_not_show():
    text = b" ".join(b"w%d" % (k % 97) for k in range(2000)) + b"  end"
    whole = np.concatenate(list(simhash.shingle_hashes(text, 3)))
    for size in (1, 7, 50, 5000):
        assert (np.concatenate(list(simhash.shingle_hashes(text, 3, size))) == whole).all()
        assert simhash.fingerprint(text, 3, size) == simhash.fingerprint(text, 3)
    assert list(simhash.shingle_hashes(b"a b", 3, 1))[0].tolist() == [xxhash.xxh64_intdigest(b"a b", 42)]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_ball_hashing_connects_what_all_pairs_connect(spark, radius):
    rng = np.random.default_rng(radius)
    heads = rng.integers(0, 2**63, 40, dtype=np.uint64)
    found = {0, 1, 2**64 - 1}
    for h in heads.tolist():
        for _ in range(6):  # near the edge of the radius, on either side
            h ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
            found.add(h)
    signed = np.array(sorted(found), np.uint64).view(np.int64)
    fps = spark.createDataFrame([(int(f),) for f in signed], "fp long")
    got = [(r.u, r.v) for r in simhash.links(fps, len(signed), radius, 3_000, 9_000).collect()]
    word = signed.view(np.uint64)
    place = {int(f): k for k, f in enumerate(signed)}
    assert all(int(word[place[u]] ^ word[place[v]]).bit_count() <= radius for u, v in got)

    def groups(pairs):
        root = list(range(len(signed)))

        def find(k):
            while root[k] != k:
                k = root[k]
            return k

        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(k) for k in range(len(signed))]

    wanted = [(a, b) for a in range(len(signed)) for b in range(a) if int(word[a] ^ word[b]).bit_count() <= radius]
    assert groups([(place[u], place[v]) for u, v in got]) == groups(wanted)
