"""Near duplicates, components and decontamination against brute force."""

import random
import re

import pytest

from tradeloom.llm import decontam, minhash
from tradeloom.llm.components import components

DOCS = "doc_id long, text string, rep string, band int, hub long, bytes string, n long"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(docs, size, percent):
    sets = {}
    for d, t in docs:
        if d is not None:
            sets.setdefault(d, []).append(shingles(t, size))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) for d in sets}


def corpus():
    draw = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    docs, n = [], 0
    for _ in range(25):
        base = draw.choices(words, k=draw.randint(20, 120))
        for _ in range(draw.randint(1, 8)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            docs.append((n := n + 1, " ".join(copy)))
    # A passage that many texts share, without being near duplicates.
    shared = " ".join(draw.choices(words, k=60))
    docs += [(n := n + 1, shared + " " + " ".join(draw.choices(words, k=20))) for _ in range(60)]
    # A chain: each near the next, the ends apart.
    chain = draw.choices(words, k=100)
    for k in range(12):
        docs.append((n := n + 1, " ".join([*chain[:k * 3], *[f"c{j}" for j in range(k * 3, 0, -1)], *chain[k * 3:]][:100])))
    docs += [(n := n + 1, "same words again and again")] * 1 + [(n + k, "Same  WORDS\tagain and again") for k in range(1, 40)]
    docs += [(1000, None), (1001, ""), (1002, " \n"), (1003, "short"), (1004, "SHORT"), (1005, "É short é"), (1006, "long " * 30000), (1007, "long " * 29000)]
    return docs


@pytest.fixture(scope="module")
def frame(spark):
    docs = corpus()
    docs += [docs[0], (1, "another text under the same id " * 3), (None, docs[0][1]), (None, "no id")]
    return spark.createDataFrame([(d, t, "clash", 1, 2, "x", 3) for d, t in docs], DOCS), docs


def test_sets_of_one_id_link_what_each_is_linked_with(spark):
    texts = {k: " ".join(f"{k}{j}" for j in range(20)) for k in "ABCD"}
    rows = [(3, "A"), (4, "B"), (5, "A"), (5, "B"), (9, "C"), (9, "D"), (8, "D"), (7, "C"), (6, "E"), (6, "F")]
    rows = [(d, texts.get(t, f"alone {t}")) for d, t in rows]
    # A row's component is its id's, and what keep_one adds to columns has no name of theirs.
    docs = spark.createDataFrame([(d, t, n, 2, "p") for n, (d, t) in enumerate(rows)], "doc_id long, text string, kept int, `__kept` int, place string")
    got = minhash.near_duplicates(docs, 4, 80).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(d, c) for d, c in brute(rows, 4, 80).items()}
    assert {r.doc_id for r in got if r.component_id == 3} == {3, 4, 5} and {r.doc_id for r in got if r.component_id == 7} == {7, 8, 9}
    kept = minhash.keep_one(docs, 4, 80)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 6, 7]
    # Of the rows under one id the same one stays, however they are dealt.
    again = minhash.keep_one(docs.orderBy(docs.kept.desc()).repartition(5), 4, 80)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, kept.collect()))


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(frame, size):
    docs, rows = frame
    got = minhash.near_duplicates(docs, size, 80).collect()
    expected = brute(rows, size, 80)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (expected[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    sizes = sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None)
    assert sizes == sorted((d, len(shingles(t, size))) for d, t in rows if d is not None)


def test_small_blocks_and_hub_groups_lose_no_link(frame, monkeypatch):
    docs, rows = frame
    monkeypatch.setattr(minhash, "BLOCK", 5)
    monkeypatch.setattr(minhash, "HUB_MEMBERS", 3)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 4, 80).collect() if r.doc_id is not None}
    assert got == brute(rows, 4, 80)


def test_one_of_each_group_stays(frame):
    docs, rows = frame
    kept = minhash.keep_one(docs, 5, 80)
    expected = brute(rows, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({d for d, c in expected.items() if d == c})
    assert kept.where("doc_id is null").count() == 2


def test_no_documents(frame):
    assert minhash.near_duplicates(frame[0].limit(0)).count() == 0
    assert minhash.keep_one(frame[0].limit(0)).count() == 0
    assert minhash.near_duplicates(frame[0].where("text is null")).collect()[0].component_id == 1000


def test_stored_steps_can_be_deleted(spark, tmp_path):
    from tradeloom.llm import runtime

    before = runtime._steps.pop(spark.sparkContext.applicationId, [])
    kept = runtime.stored(spark.range(3), "step")
    folder = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    runtime.forget_steps(spark)
    assert not __import__("os").path.exists(folder)
    runtime._steps[spark.sparkContext.applicationId] = before


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (500, 499), (500, 499)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 499: 499, 500: 499}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(docs, items, size=10):
    found = {}
    for item, text in items:
        w = WORD.findall(low(text))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            found.setdefault(tuple(w[k : k + size]), set()).update([] if item is None else [str(item)])
    out = []
    for text in docs:
        w, hit, names = WORD.findall(low(text)), set(), set()
        for n in {len(x) for x in found}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in found:
                    hit |= set(range(k, k + n))
                    names |= found[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(names)))
    return out


def test_index_equals_brute_force_on_random_texts():
    draw = random.Random(3)
    for _ in range(150):
        words = [draw.choice("abcdé9") * draw.randint(1, 2) for _ in range(draw.randint(1, 6))]
        items = [(k, " ".join(draw.choices(words, k=draw.randint(0, 14)))) for k in range(draw.randint(0, 5))]
        docs = [" ".join(draw.choices([*words, "zz", "Q"], k=draw.randint(0, 60))) for _ in range(draw.randint(0, 6))]
        size = draw.choice([2, 3, 10])
        want = decontam.windows([(str(i), t.encode()) for i, t in items], size)
        texts = [decontam.words(t.encode()) for t in docs]
        begin, hit, names = decontam.occurrences(texts, want)
        got = [(len(w), int(hit[a:b].sum()), sorted(i)) for w, a, b, i in zip(texts, begin[:-1], begin[1:], names, strict=True)]
        assert got == brute_hits(docs, items, size)


@pytest.fixture(scope="module")
def leaks(spark):
    draw = random.Random(8)
    items = [(k, " ".join(f"q{draw.randrange(300)}" for _ in range(draw.randint(3, 40)))) for k in range(30)]
    items += [(30, None), (31, ""), (32, "Ünï-código 9"), (None, "no id at all"), (33, items[0][1])]
    # Without an id: windows of its own and some that another item has as well. A huge item, and a repeated one.
    items += [(None, items[5][1] + " " + " ".join(f"none{k}" for k in range(15)))] + [(34, " ".join(f"big{k}" for k in range(900)))] + [items[6]] * 50
    docs = [None, "", "---", "ÜNÏ CÓDIGO 9 is Ünï_código,9!", "free of it", "long " * 40000, items[0][1].upper(), "x " + items[1][1] + " y " + items[1][1]]
    w = items[2][1].split()
    docs += [" ".join(w[:6]) + " " + " ".join(w[3:9]), items[4][1] * 2, items[4][1] * 2]
    docs += ["so No Id at ALL, it says", items[5][1], "x " + " ".join(f"none{k}" for k in range(12)), " ".join(f"Big{k}" for k in range(300, 330)), items[6][1]]
    for _ in range(40):
        a = draw.choice(items[:30])[1].split()
        docs.append(" ".join([*draw.choices(["f", "g"], k=5), *a[draw.randrange(len(a)) :], *draw.choices(["f", "g"], k=5)]))
    bench = spark.createDataFrame([(i, t, "clash", 1) for i, t in items], "item_id long, text string, doc_id string, spans int")
    frame = spark.createDataFrame([(k, t, "x", 0, "y") for k, t in enumerate(docs)] + [(None, docs[3], "", 0, "")], "doc_id long, text string, item_id string, spans int, row string")
    return frame, bench, [*docs, docs[3]], items


@pytest.mark.parametrize("block_words", [decontam.BLOCK_WORDS, 60])
def test_contamination(leaks, monkeypatch, block_words):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block_words)
    frame, bench, docs, items = leaks
    expected = brute_hits(docs, items)
    rows = {(r.doc_id): r for r in decontam.contamination(frame, bench).collect()}
    for k, e in [*enumerate(expected[:-1]), (None, expected[-1])]:
        r = rows[k]
        assert (r.n_words, r.n_hit, list(r.item_ids)) == e
        assert sum(s.stop - s.start for s in r.spans) == r.n_hit


@pytest.mark.parametrize("block_words", [decontam.BLOCK_WORDS, 100])
def test_cut_texts_hold_no_window(leaks, monkeypatch, block_words):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block_words)
    frame, bench, docs, items = leaks
    cut = decontam.decontaminate(frame, bench)
    assert cut.columns == frame.columns
    rows = {r.doc_id: r.text for r in cut.collect()}
    assert all(n == 0 for _, n, _ in brute_hits(list(rows.values()), items))
    for k, (_, n, _) in enumerate(brute_hits(docs[:-1], items)):
        assert n or rows[k] == docs[k]


def plain_cut(text, items, size=10):
    """All items' windows found, then cut, until none is left."""
    found = {}
    for _, t in items:
        w = WORD.findall(low(t))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            found[tuple(w[k : k + size])] = True
    while True:
        at = list(WORD.finditer(text))
        w = [low(m[0]) for m in at]
        hit = {p for n in {len(x) for x in found} for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in found for p in range(k, k + n)}
        if not hit:
            return text
        runs = [(a, next(b for b in range(a, len(w) + 1) if b not in hit)) for a in sorted(hit) if a - 1 not in hit]
        for a, b in reversed(runs):
            text = text[: at[a].start()] + text[at[b - 1].end() :]


@pytest.mark.parametrize("block_words", [decontam.BLOCK_WORDS, 40])
def test_parts_cut_what_one_part_cuts(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block_words)
    w = [f"w{k}" for k in range(1, 41)]
    # Windows that overlap, and one that a cut brings together, in both orders of the items' parts.
    items = [(k, " ".join(w[5 * k : 5 * k + 10])) for k in range(7)] + [(100 + k, " ".join(f"{p}{k}" for p in "abcdefghij")) for k in range(12)]
    docs = [" ".join(["x,", *w[:15], "; y"]), " ".join(w[:35]), " ".join(w), " ".join(w[12:31]) + "."]
    for k in range(12):
        for j in range(12):
            docs.append(" ".join([*(f"{p}{k}" for p in "abcde"), *(f"{p}{j}" for p in "abcdefghij"), *(f"{p}{k}" for p in "fghij"), "end"]))
    frame = spark.createDataFrame([(k, t, "r", 1) for k, t in enumerate([*docs, None])], "doc_id long, text string, row string, round int")
    cut = decontam.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert cut.columns == frame.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {**{k: plain_cut(t, items) for k, t in enumerate(docs)}, len(docs): None}


def test_nothing_to_search(leaks):
    frame, bench, docs, _ = leaks
    assert decontam.contamination(frame.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontam.contamination(frame, bench.limit(0)).collect()} == {0}
    assert decontam.decontaminate(frame, bench.limit(0)).count() == len(docs)
