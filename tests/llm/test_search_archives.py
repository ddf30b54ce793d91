"""Nearest neighbours against brute force; archives by exact round trip."""

import hashlib
import io
import random

import numpy as np
import pytest
import zstandard

from tradeloom.llm import neighbours, warc

VECTORS = "vec_id long, embedding array<double>, class string, block int, query int"


def brute(rows, k=10, every=100):
    good = {(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in good:
        if q % every:
            continue
        for i, b in good:
            if i != q and len(a) == len(b):
                d = float(np.sqrt(((np.array(b) - np.array(a)) ** 2).sum()))
                out.setdefault(q, {})[i] = min(d, out.get(q, {}).get(i, np.inf))
    return {q: sorted((d, i) for i, d in found.items())[:k] for q, found in out.items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1, 2) for i, v in rows], VECTORS)


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_all_verified_equals_brute_force(spark):
    draw = np.random.default_rng(1)
    rows = [(k, draw.integers(-2, 3, 4).astype(float).tolist()) for k in range(450)]
    rows += [(1000 + k, [1.0, 2.0, 3.0, 4.0]) for k in range(300)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 4), (2003, [1.0, None, 0.0, 0.0]), (2004, [float("nan")] * 4), (2100, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(3000, [1.0, -0.0]), (3001, [1.0, 0.0]), (3002, [2.0, 0.0]), (100, rows[100][1]), (200, [9.0] * 4)]
    got = answers(neighbours.nearest(frame(spark, rows), block=100, verified=1.0))
    expected = brute(rows)
    assert got.keys() == expected.keys()
    for q, e in expected.items():
        assert [i for _, i in got[q]] == [i for _, i in e], q
        assert np.allclose([d for d, _ in got[q]], [d for d, _ in e], rtol=0, atol=1e-12)


def test_the_order_of_queries_does_not_show():
    draw = np.random.default_rng(4)
    vectors, queries = draw.standard_normal((1500, 16)), draw.standard_normal((20, 16)) * draw.uniform(0.1, 5, (20, 1))
    found = []
    for order in (range(20), reversed(range(20)), draw.permutation(20)):
        index = neighbours.LineIndex(vectors)
        found.append({int(q): index.search(queries[q], 10)[0].tolist() for q in order})
    assert found[0] == found[1] == found[2]
    # The level that is found is the lowest with enough vectors, whatever the search begins with.
    index = neighbours.LineIndex(vectors)
    for level in (0, 30, 90):
        index.level = level
        assert index.search(queries[0], 10)[0].tolist() == found[0][0]
    assert neighbours.LineIndex(vectors[:1]).search(queries[0], 10)[0].tolist() == [0]


def test_recall(spark):
    draw = np.random.default_rng(2)
    rows = [(k, (draw.standard_normal(64)).tolist()) for k in range(3000)]
    got, expected = answers(neighbours.nearest(frame(spark, rows), block=1000)), brute(rows)
    recall = np.mean([len({i for _, i in got[q]} & {i for _, i in e}) / 10 for q, e in expected.items()])
    assert recall >= 0.9


def test_few_or_no_vectors(spark):
    assert neighbours.nearest(frame(spark, [])).count() == 0
    assert neighbours.nearest(frame(spark, [(100, [1.0])])).count() == 0
    assert answers(neighbours.nearest(frame(spark, [(100, [1.0]), (1, [3.0]), (200, [1.0])]))) == {100: [(0.0, 200), (2.0, 1)], 200: [(0.0, 100), (2.0, 1)]}


PAGES = "page_id long, url string, html string, digest string, n int, winner long"


def pages():
    draw = random.Random(6)
    big = ["".join(draw.choices("<p>abc é漢\r\n", k=draw.randint(1000, 6000))) for _ in range(12)]
    rows = [(k, f"http://x/{k}", draw.choice(big) if k % 3 else f"small {k % 5}") for k in range(120)]
    rows += [(200, None, None), (201, "", ""), (202, "http://x/\r\nWARC-Type: no", "WARC/1.1\r\n\r\n" * 200), (203, "u", "y" * 400_000), (204, "u", "y" * 400_000)]
    rows += [(None, "n", big[0]), (None, "n", "z" * 2000), (None, "n", "z" * 2000), rows[1], rows[1]]
    return rows


@pytest.mark.parametrize("size", [warc.ARCHIVE_BYTES, 20_000])
def test_archives_round_trip(spark, monkeypatch, size):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
    rows = pages()
    manifest = warc.write_archives(spark.createDataFrame([(*r, "clash", 0, 9) for r in rows], PAGES))
    for r in manifest.collect():
        with open(r.path.removeprefix("file:"), "rb") as f:
            assert int.from_bytes(f.read(4), "little") == warc.DICTIONARY_FRAME
    got = warc.read_archives(manifest).collect()
    winner = {}
    for i, _, html in rows:
        if len(body := (html or "").encode()) >= 1000 and i is not None:
            winner[body] = max(i, winner.get(body, -1))
    expected = []
    for i, _, html in rows:
        body = (html or "").encode()
        first = winner.get(body, i)
        revisit = first != i
        expected.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None, None if revisit else body))
    key = lambda r: tuple((x is not None, x) for x in r)
    seen = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(seen, key=key) == sorted(expected, key=key)
    assert {r.url for r in got if r.page_id == 202} == {"http://x/%0D%0AWARC-Type:%20no"}


def test_archive_frames():
    records = [warc.record(k, f"http://x/{k}", f"<html>shared words {k}</html>".encode() * 20, 1, "d", None, "1970-01-01T00:00:00Z") for k in range(300)]
    data = warc.archive(records)
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D
    n = int.from_bytes(data[4:8], "little")
    learned = zstandard.ZstdCompressionDict(data[8 : 8 + n])
    at, plain = 8 + n, []
    while at < len(data):
        # Each record is a frame of its own, which the dictionary alone opens.
        unpacker = zstandard.ZstdDecompressor(dict_data=learned).decompressobj()
        plain.append(unpacker.decompress(data[at:]))
        at = len(data) - len(unpacker.unused_data)
    assert plain == records
    assert len(list(warc.parse(io.BytesIO(data)))) == 300
    assert len(list(warc.parse(io.BytesIO(warc.archive(records[:1]))))) == 1


def test_cut_archive_is_noticed(spark, tmp_path):
    records = [warc.record(k, None, b"x" * 50, 50, hashlib.sha1(b"x" * 50).hexdigest(), None, "1970-01-01T00:00:00Z") for k in range(30)]
    path = tmp_path / "cut.warc.zst"
    path.write_bytes(warc.archive(records)[:-60])
    with pytest.raises(Exception, match="records, not|ends within"):
        warc.read_archives(spark.createDataFrame([(str(path), 30, 0)], warc.MANIFEST)).collect()


def test_no_pages(spark):
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], PAGES))).count() == 0
