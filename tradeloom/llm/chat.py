"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered as a whole and encoded once; the tokenizer gives each
token's place in the text. Turn spans and token spans are both sorted, so the
tokens of an assistant's text are found by binary search.

A turn is ``<|endoftext|>### role:``, ``<|endoftext|>``, text, ``<|endoftext|>``,
``</turn>`` line end. The added token on either side of a text cuts before
anything else, so that no token crosses the text's edges. In
texts and roles a backslash is doubled, and one is put within ``<|`` and ``</``,
so that neither marker can occur; in roles colons are escaped too. Unescaping
drops each backslash before a character.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.bytebpe import tokenizer
from tradeloom.llm.runtime import ship

TOKENIZER = "byte_bpe_50k.json"
START, END = "<|endoftext|>", "</turn>\n"
HEAD = re.compile(r"### ((?:[^\\:]|\\.)*):", re.S)
#: Characters of whole turns that are encoded at a time. A longer conversation is encoded in parts: its turns begin
#: with an added token, at which the tokenizer cuts a text before anything else, so the ids are those of the whole.
PART_CHARS = 4 << 20
FORMATTED = "conv_id long, part int, n_turns long, text string, token_ids array<int>, loss_mask array<byte>, loss_spans array<struct<start:int,stop:int>>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|").replace("</", "<\\/")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation's text, and where each turn's text stands in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}### {escape(role).replace(':', chr(92) + ':')}:{START}", escape(text)
        parts += [head, body, START, END]
        spans.append((at + len(head), at + len(head) + len(body)))
        at = spans[-1][1] + len(START) + len(END)
    return "".join(parts), spans


@functools.lru_cache(maxsize=2)
def _encoder(name: str):
    from tokenizers import Tokenizer
    from tokenizers.processors import ByteLevel

    own = Tokenizer.from_str(tokenizer(name).to_str())
    own.post_processor = ByteLevel(trim_offsets=False)  # the ids are the same; a token's place then includes its space
    return own


def encode(text: str, spans: list[tuple[int, int]], name: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Token ids, a mask of the tokens within a span, and the spans that are not empty. A token across a span's edge is an error."""
    found = _encoder(name).encode(text, add_special_tokens=False)
    at = np.array(found.offsets, np.int64).reshape(-1, 2)
    starts, stops = at[:, 0], at[:, 1]
    mask, under = np.zeros(len(at), np.int8), []
    first = np.searchsorted(stops, [s for s, _ in spans], side="right")
    last = np.searchsorted(starts, [e for _, e in spans], side="left")
    for (s, e), a, b in zip(spans, first.tolist(), last.tolist(), strict=True):
        if s < e:
            if starts[a] != s or stops[b - 1] != e:
                raise ValueError(f"a token crosses the edge of the text at {s} to {e}")
            mask[a:b] = 1
            under.append((s, e))
    return np.array(found.ids, np.int32), mask, under


def format_conversations(conversations: DataFrame, loss_role: str = "assistant", tokenizer_name: str = TOKENIZER, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation, in order within its partition: rendered text, token ids, loss mask by token, loss spans.

    Turns are ordered by number, equal numbers by role and text; null numbers come first. A null text or role is
    empty. Rows without an id are one conversation, whose id is null. Repeated rows are turns like any others. An empty table
    gives none; other columns are not read. One conversation is read as a stream and rendered in one ``part``, or, beyond PART_CHARS, in several of whole turns.
    """
    ship(conversations.sparkSession)
    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(conv: int | None, part: int, turns: list[tuple[str, str]]) -> tuple:
            text, spans = render(turns)
            ids, mask, under = encode(text, [s for s, (role, _) in zip(spans, turns, strict=True) if role == loss_role], tokenizer_name)
            return conv, part, len(turns), text, ids, mask, [{"start": a, "stop": b} for a, b in under]

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int8()), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names=[f.split(" ")[0] for f in FORMATTED.split(", ")])

        conv, part, turns, chars = None, 0, [], 0
        done, size = [], 0
        for batch in batches:
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
                if turns and (c != conv or chars + len(text) > PART_CHARS):
                    done.append(made(conv, part, turns))
                    size += chars
                    part, turns, chars = (part + 1 if c == conv else 0), [], 0
                    if size > PART_CHARS:
                        yield batch_of(done)
                        done, size = [], 0
                conv = c
                turns.append((role, text))
                chars += len(text)
        if turns:
            done.append(made(conv, part, turns))
        yield batch_of(done)

    return rows.mapInArrow(run, FORMATTED)


def masked_texts(ids: list[int], mask: bytes | list[int], name: str = TOKENIZER) -> list[str]:
    """The texts of the runs of ids under the mask."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(mask), np.int8), [0]]))).tolist()
    return _encoder(name).decode_batch([ids[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)], skip_special_tokens=False)


def read_back(formatted: DataFrame, tokenizer_name: str = TOKENIZER) -> DataFrame:
    """Digests of conversations from their formatted parts, which come in order as ``format_conversations`` gives them.

    Turns are parsed from the text and unescaped. The loss text is decoded from the ids under the mask, run by run, and
    unescaped; a part that does not parse, or whose masked ids are not the text under its loss spans, raises an error.
    A null id is a conversation's like any other; an empty table gives none.
    """
    ship(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names=[f.split(" ")[0] for f in DIGEST.split(", ")])

        def close() -> tuple:
            conv, n, turns, chars, loss, total = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), total

        for batch in batches:
            done = []
            for conv, part, text, ids, mask, spans in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "part", "text", "token_ids", "loss_mask", "loss_spans")), strict=True):
                if not part:
                    if state:
                        done.append(close())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                pieces = text.split(START)[1:]
                for head, body, end in zip(pieces[::3], pieces[1::3], pieces[2::3], strict=True):
                    role = HEAD.fullmatch(head)
                    if not role or end != END:
                        raise ValueError(f"not a turn in conversation {conv}")
                    state[1] += 1
                    state[2].update(f"{unescape(role[1])}\n{unescape(body)}\n".encode())
                masked = masked_texts(ids, mask, tokenizer_name)
                if masked != [text[s["start"] : s["stop"]] for s in spans]:
                    raise ValueError(f"masked tokens are not the loss text in conversation {conv}")
                for loss in map(unescape, masked):
                    state[3] += len(loss)
                    state[4].update(loss.encode())
                state[5] += len(text)
            yield batch_of(done)
        if state:
            yield batch_of([close()])

    return formatted.select("conv_id", "part", "text", "token_ids", "loss_mask", "loss_spans").mapInArrow(run, DIGEST)
