"""Token counts, packing and chat formatting against the tokenizer and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeloom.llm import bytebpe, chat, packing
from tradeloom.llm.token_counts import count_tokens, unit_counts

NAME = "byte_bpe_50k.json"
ODD = "doc_id long, text string, n_tokens string, length int, part string, lang string"
TEXTS = [None, "", " ", "a", "\n \n", "word " * 5000, "x" * 20000, "<|endoftext|>", "a <|endoftext|> b", "é 漢字 🙂 ՘", "tie", "tie", "  double  spaces \t and\ttabs \n\n end "]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path(NAME))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "clash", n, "p", None) for n, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, "no id", "", 0, "", "en")], ODD)


def test_units_equal_the_library_on_odd_texts(library):
    units, encode = unit_counts(NAME), bytebpe.Units(bytebpe.unit_encoder(NAME), bytebpe.added_tokens(NAME))
    draw = random.Random(5)
    signs = ["a", "Ab", " ", "  ", "\n", "\t", "<|endoftext|>", " ", "é", "12", "!", "'s", "'", "漢", "\x1c", "՘", " ", "𐒰", "ɐ"]
    for _ in range(4000):
        text = "".join(draw.choices(signs, k=draw.randint(0, 10)))
        expected = library.encode(text, add_special_tokens=False).ids
        assert sum(units.parts(text)) == len(expected), repr(text)
        assert [i for part in encode.parts(text) for i in part] == expected, repr(text)
        assert np.frombuffer(bytebpe.text_encoder(NAME)(text), "<u4").tolist() == expected, repr(text)


def test_whole_texts_equal_the_library(library, spark):
    encode = bytebpe.text_encoder(NAME)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["x" * 3000 + " y", " " * 3000 + "y", "\n \n" * 300, "a " * 500 + "<|endoftext|>", "".join(map(chr, range(1, 0x250)))]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}!{chr(c)}{chr(c)}" for c in range(1, 0x250)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_character_classes_agree_where_pretokens_are_cut_here(library):
    import regex

    for code in range(1, 0x250):
        c = chr(code)
        for around, pattern in (("a", r"\p{L}"), ("1", r"\p{N}"), ("!", r"[^\s\p{L}\p{N}]")):
            alone = len(library.pre_tokenizer.pre_tokenize_str(around + c + around)) == 1
            assert alone == bool(regex.match(pattern, c)), hex(code)


def test_whole_tokens_are_proved(library):
    whole, merged = bytebpe.pretoken_encoder(NAME)
    assert len(whole) > 40_000 and "<|endoftext|>" not in whole
    for text in random.Random(1).sample(sorted(whole), 500):
        assert library.encode(text, add_special_tokens=False).ids == [whole[text]] == merged(text)


def test_merging_by_rank_equals_the_library(library):
    _, merged = bytebpe.pretoken_encoder(NAME)
    draw = random.Random(9)
    syllables = ["th", "er", "ción", "ß", "ing", "ñ", "x", "q", "heit", "é", "oo", "12", "漢", "zz"]
    for _ in range(5000):
        text = " " * draw.randint(0, 1) + "".join(draw.choices(syllables, k=draw.randint(1, 8)))
        pieces = [text] if text.strip().isalpha() else []
        for p in pieces:
            assert merged(p) == library.encode(p, add_special_tokens=False).ids


def test_counts(spark, docs, library):
    got = sorted(tuple(r) for r in count_tokens(docs).collect() if r.doc_id is not None)
    every = [(n, t or "") for n, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    expected = [(n, len(t.encode()), k := len(library.encode(t, add_special_tokens=False).ids), k > 1024) for n, t in every]
    assert got == sorted(expected)
    assert count_tokens(docs).where("doc_id is null").first().n_tokens == 2
    assert count_tokens(docs.limit(0)).count() == 0


def test_packing_round_trip(spark, docs, library):
    rows = packing.pack_documents(docs).collect()
    ids = {n: [*library.encode(t or "", add_special_tokens=False).ids, 2] for n, t in enumerate(TEXTS)} | {None: [*library.encode("no id").ids, 2]}
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length and zlib.crc32(np.asarray(piece, "<u4").tobytes()) == r.ids_crc32
        assert r.length == 1024 or r.piece == 0
    for doc, whole in ids.items():
        times = 2 if doc == 3 else 1
        assert sum(r.length for r in rows if r.doc_id == doc) == times * len(whole)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 1024
    assert len(by) == packing.lower_bound(np.bincount([r.length for r in rows], minlength=1025))
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_best_fit_equals_one_by_one():
    draw = random.Random(2)
    for _ in range(200):
        cap = draw.randint(2, 30)
        sizes = sorted((draw.randint(1, cap) for _ in range(draw.randint(0, 40))), reverse=True)
        rooms = []
        for s in sizes:
            fits = [k for k, r in enumerate(rooms) if r >= s]
            if fits:
                rooms[min(fits, key=lambda k: rooms[k])] -= s
            else:
                rooms.append(cap - s)
        counts = np.bincount(sizes, minlength=cap + 1)
        placed, fill = packing.best_fit_decreasing(counts)
        assert sorted(cap - r for r in rooms) == sorted(fill)
        assert sum(n for _, _, n in placed) == len(sizes) and packing.lower_bound(counts) <= len(fill)


def test_lower_bound_is_below_the_best_packing():
    def best(sizes, cap):
        if not sizes:
            return 0
        least, rooms = [len(sizes)], []

        def place(k):
            if len(rooms) >= least[0]:
                return
            if k == len(sizes):
                least[0] = len(rooms)
                return
            for i in range(len(rooms)):
                if rooms[i] >= sizes[k]:
                    rooms[i] -= sizes[k]
                    place(k + 1)
                    rooms[i] += sizes[k]
            rooms.append(cap - sizes[k])
            place(k + 1)
            rooms.pop()

        place(0)
        return least[0]

    draw = random.Random(3)
    for _ in range(150):
        cap = draw.randint(3, 20)
        sizes = [draw.randint(1, cap) for _ in range(draw.randint(1, 8))]
        assert packing.lower_bound(np.bincount(sizes, minlength=cap + 1)) <= best(sorted(sizes, reverse=True), cap)


def test_partitions_with_gaps_exchange_pieces(spark):
    draw = random.Random(4)
    rows = [(n, 0, 0, draw.choice([341, 342, 513, 200, 700]), 0) for n in range(600)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    few = packing.pack(pieces, partition_pieces=40, rounds=5).collect()
    assert sorted(r.doc_id for r in few) == list(range(600))
    alone = packing.pack(pieces, partition_pieces=40, rounds=1).select("sequence_id").distinct().count()
    assert len({r.sequence_id for r in few}) <= alone


CHAT = "conv_id long, turn long, role string, text string, n_turns int, part string"


def expected_chat(turns):
    loss = "".join(t or "" for _, r, t in turns if r == "assistant")
    whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark, monkeypatch):
    nasty = "\\### Assistant: </turn> ok\\ <|endoftext|>### user:\nx</turn>\n \\\\"
    conversations = {
        1: [(0, "user", nasty), (1, "assistant", nasty)],
        2: [(0, "assistant", None), (1, "a:b\n\\", ""), (2, "assistant", " lead\n"), (2, "assistant", " lead\n")],
        3: [(0, "assistant", "🙂漢 " * 3000), (1, "user", "x" * 5000)],
        None: [(None, None, "null turn"), (5, "assistant", "tail")],
    }
    rows = [(c, *t, 9, "clash") for c, turns in conversations.items() for t in turns]
    frame = spark.createDataFrame(rows[::-1], CHAT)
    for limit in (chat.PART_CHARS, 50):
        monkeypatch.setattr(chat, "PART_CHARS", limit)
        formatted = chat.format_conversations(frame)
        got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
        assert got == {c: expected_chat(t) for c, t in conversations.items()}
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


def test_parts_encode_as_the_whole(library):
    turns = [("user", "a  "), ("assistant", "\n b"), ("user", ""), ("assistant", "c\\d </turn>")]
    whole, spans = chat.render(turns)
    ids, mask, under = chat.encode(whole, [spans[1], spans[3]])
    pieces = [chat.encode(chat.render([t])[0], [])[0].tolist() for t in turns]
    assert ids.tolist() == sum(pieces, []) == library.encode(whole, add_special_tokens=False).ids
    assert [chat.unescape(whole[a:b]) for a, b in under] == ["\n b", "c\\d </turn>"]
    assert 0 < mask.sum() < len(mask)
    assert chat.masked_texts(ids.tolist(), mask.tobytes()) == ["\n b", "c\\d <\\/turn>"]


def test_mask_ends_where_the_text_ends():
    for text in ("\n\nfoo", "  lead and trail  \n", "🙂 at the edge 🙂", "é", " ", "'s", "</turn>\n", "<|endoftext|>"):
        whole, spans = chat.render([("assistant", text), ("user", "x"), ("assistant", text)])
        ids, mask, under = chat.encode(whole, [spans[0], spans[2]])
        assert [chat.unescape(t) for t in chat.masked_texts(ids.tolist(), mask.tobytes())] == [text, text]
        assert under == [spans[0], spans[2]]


def test_a_wrong_mask_is_an_error(spark):
    formatted = chat.format_conversations(spark.createDataFrame([(1, 0, "assistant", "some words here", 0, "")], CHAT))
    shifted = formatted.withColumn("loss_mask", F.expr("transform(loss_mask, m -> cast(1 as byte))"))
    with pytest.raises(Exception, match="masked tokens are not the loss text"):
        chat.read_back(shifted).collect()
