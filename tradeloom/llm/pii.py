"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns' matches always stay. The field scores whole candidate segments,
of a few tokens at most, by features of the segment, and a dynamic programme
chooses boundaries and types of all entities of a region together. It is trained
here, on what the patterns and a few seeds for secrets find, and adds spans
that the patterns drop, such as a telephone number that runs on into a card
number. Tokens far from any digit or @ cannot be part of an entity, so a text
falls into short regions that are solved one by one, exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.runtime import begins, ship, thinned, windowed

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
# What the four kinds look like. An address is found from its @, with the same matches as by scanning.
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Seeds label what the base patterns leave: secrets by their key words, telephone numbers without a + after theirs.
SECRET_SEEDS = (re.compile(r"\b(AKIA[0-9A-Z]{16})\b"), re.compile(r"(?i)\b(?:password|passwd|pwd|token|secret|api_?key)\s*[=:]\s*[\"']?([0-9A-Za-z_/+-]{12,})"))
PHONE_SEED = re.compile(r"(?i)\b(?:tel|telephone|phone|mobile|cell|fax|call)(?: (?:me|us))?(?: (?:at|on))?[.:]? ?(\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,5}){1,4})(?![0-9])")
#: What segments of the field can be. A telephone number without a + has a sign or brackets between its groups.
LOOSE_PHONE = re.compile(r"\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,5}){1,4}")
LOOSE_SECRET = re.compile(r"[0-9A-Za-z]+(?:[_/+-]+[0-9A-Za-z]+)*")

TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
TRIGGER = re.compile(r"[0-9@]")
NEAR = re.compile(r"[A-Za-z0-9._%+@()=:\"'/-]")
#: A segment has at most so many tokens and characters.
SEGMENT_TOKENS, SEGMENT_CHARS = 24, 80


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def _ip_valid(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _card_valid(text: str) -> bool:
    d = digits_of(text)
    return 16 <= len(d) <= 19 and luhn(d)


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """Matches of the fixed patterns, by kind and start; and what was dropped for its digits."""
    out, dropped = [("email", a, b) for a, b in _emails(text)], []
    if not TRIGGER.search(text):
        return out, dropped
    for kind, pattern, valid in (("ip", IP, _ip_valid), ("card", CARD, _card_valid), ("phone", PHONE, lambda s: 8 <= len(digits_of(s)) <= 15)):
        for m in pattern.finditer(text):
            if valid(m[0]):
                out.append((kind, *m.span()))
            else:
                dropped.append(m.span())
    return out, dropped


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold every possible entity: entity characters around digits and @, with single spaces between."""
    last = 0
    for m in TRIGGER.finditer(text):
        if m.start() < last:
            continue
        start = m.start()
        while start > last and m.start() - start < SEGMENT_CHARS and NEAR.match(text[start - 1]):
            start -= 1
        stop, far = m.end(), m.end()
        while stop < len(text) and stop - far < SEGMENT_CHARS:
            c = text[stop]
            if "0" <= c <= "9" or c == "@":
                far = stop
            elif not (NEAR.match(c) or c == " " and stop + 1 < len(text) and text[stop + 1] in "0123456789(+@" and text[stop - 1] in "0123456789)-"):
                break
            stop += 1
        yield start, stop
        last = stop


def _possible(s: str, before: str, after: str) -> list[str]:
    """Types that a segment could be of at all."""
    if before.isalnum() and s[0].isalnum() or after.isalnum() and s[-1].isalnum():
        return []
    out = []
    if "@" in s:
        a, b = next(_emails(s), (0, 0))
        return ["email"] if b - a == len(s) else []
    d = digits_of(s)
    if not d:
        return []
    letters = any("a" <= c.lower() <= "z" for c in s)
    if not letters:
        if s.count(".") == 3 and IP.fullmatch(s) and _ip_valid(s):
            out.append("ip")
        if 16 <= len(d) <= 19 and CARD.fullmatch(s) and luhn(d):
            out.append("card")
        if 8 <= len(d) <= 15 and PHONE.fullmatch(s) or 9 <= len(d) <= 12 and LOOSE_PHONE.fullmatch(s) and before not in ("+", "(", "."):
            out.append("phone")
    elif 12 <= len(s) <= SEGMENT_CHARS and LOOSE_SECRET.fullmatch(s) and not (before in ("_", "/", "+", "-") or after in ("_", "/", "+", "-")):
        out.append("secret")
    return out


def _shape(s: str) -> str:
    """Runs of digits by their length, signs as they are."""
    return re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 20)}", s)


def _class(c: str) -> str:
    return "edge" if not c else "space" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def segment_features(text: str, start: int, stop: int, kind: str) -> list[str]:
    """What a whole segment says for a type."""
    s, before, after = text[start:stop], text[start - 1 : start], text[stop : stop + 1]
    d = digits_of(s)
    out = [f"{kind}", f"{kind} before {_class(before)}", f"{kind} after {_class(after)}", f"{kind} digits {min(len(d), 20)}"]
    if kind in ("phone", "ip", "card"):
        if kind == "phone":
            out += [f"phone plus {s[0] == '+'}", f"phone word {bool(re.search('(?i)(tel|phone|mobile|cell|fax|call|call me|call us)[a-z]*( at| on)?[.:]? ?$', text[max(0, start - 24) : start]))}"]
        out.append(f"{kind} shape {_shape(s)}" if kind == "phone" else f"{kind} signs {''.join(sorted(set(s) - set('0123456789')))}")
    elif kind == "email":
        out.append(f"{kind} dots {min(s.rpartition('@')[2].count('.'), 4)}")
    else:
        letters = [c for c in s if c.isalpha()]
        out += [
            f"{kind} length {min(len(s) // 4, 10)}",
            f"{kind} hex {all(c in '0123456789abcdef' for c in s)}",
            f"{kind} upper {all(c.isupper() for c in letters)}",
            f"{kind} share {min(4, 5 * len(d) // len(s))}",
            f"{kind} joints {''.join(sorted(set(s) & set('_/+-')))}",
            f"{kind} words {sum(len(w) > 3 for w in re.findall('[a-z]+', s))}",
            f"{kind} runs {min(8, len(re.findall('[0-9]+|[A-Za-z]+', s)))}",
            f"{kind} key {bool(re.search('(?i)(pass|pwd|token|secret|key)[a-z_]*[^0-9A-Za-z]{0,4}$', text[max(0, start - 24) : start]))}",
        ]
    return out


@dataclass
class Field:
    """A semi-Markov conditional random field: a weight for each feature of a whole segment; outside tokens score 0."""

    weights: dict[str, float] = field(default_factory=dict)

    def score(self, features: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in features)


def candidates(text: str, start: int, stop: int) -> tuple[list[int], list[tuple[int, int, str]]]:
    """A region's token boundaries, and its possible segments as (first boundary, last boundary, type)."""
    at = [start, *(m.end() for m in TOKEN.finditer(text, start, stop))]
    out = []
    for i in range(len(at) - 1):
        if text[at[i]].isspace():
            continue
        for j in range(i + 1, min(i + SEGMENT_TOKENS, len(at) - 1) + 1):
            if at[j] - at[i] > SEGMENT_CHARS:
                break
            if at[j] - at[i] < 5 or not text[at[j] - 1].isalnum() or text[at[i]] in "_/-.:'\"=%)":
                continue
            out += [(i, j, kind) for kind in _possible(text[at[i] : at[j]], text[at[i] - 1 : at[i]], text[at[j] : at[j] + 1])]
    return at, out


def decode(text: str, model: Field, start: int, stop: int) -> list[tuple[str, int, int]]:
    """The best segmentation of a region, by the best score up to each boundary."""
    at, possible = candidates(text, start, stop)
    ending: dict[int, list[tuple[int, str, float]]] = {}
    for i, j, kind in possible:
        ending.setdefault(j, []).append((i, kind, model.score(segment_features(text, at[i], at[j], kind))))
    best, back = [0.0] * len(at), [None] * len(at)
    for j in range(1, len(at)):
        best[j] = best[j - 1]
        for i, kind, s in ending.get(j, ()):
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, kind)
    out, j = [], len(at) - 1
    while j > 0:
        if back[j]:
            i, kind = back[j]
            out.append((kind, at[i], at[j]))
            j = i
        else:
            j -= 1
    return out[::-1]


def _plus(a: float, b: float) -> float:
    low, high = (a, b) if a < b else (b, a)
    return high + log(1 + exp(low - high))


def labels_of(text: str, base: list[tuple[str, int, int]]) -> dict[tuple[int, int], str]:
    """Disjoint labels of a text: base matches and seeds, longer ones first."""
    found = [*base, *(("secret", *m.span(1)) for seed in SECRET_SEEDS for m in seed.finditer(text))]
    found += [("phone", *m.span(1)) for m in PHONE_SEED.finditer(text) if 9 <= len(digits_of(m[1])) <= 12]
    gold: dict[tuple[int, int], str] = {}
    covered: set[int] = set()
    for kind, a, b in sorted(found, key=lambda s: (s[1] - s[2], s[1], ALL_KINDS.index(s[0]))):
        if covered.isdisjoint(range(a, b)):
            covered.update(range(a, b))
            gold[a, b] = kind
    return gold


def train(texts: list[str], rounds: int = 12, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """By gradient ascent on the likelihood of the regions' labels, the sums over all segmentations by forward and backward.

    Labels are base matches and seeds; of those that overlap, the longest, then the first, then by the order of kinds, as no
    segmentation holds two. A region with a dropped match that no label covers is uncertain and left out.
    """
    data, seen = [], set()
    for text in texts:
        base, dropped = base_spans(text)
        gold = labels_of(text, base)
        unsure = [(a, b) for a, b in dropped if b - a > 5 and not any(c <= a and b <= d for c, d in gold)]
        for start, stop in regions(text):
            if any(a < stop and start < b for a, b in unsure):
                continue
            at, possible = candidates(text, start, stop)
            if not possible:
                continue
            segments = [(i, j, segment_features(text, at[i], at[j], kind), gold.get((at[i], at[j])) == kind) for i, j, kind in possible]
            # Equal regions teach once.
            key = str([(i, j, f, g) for i, j, f, g in segments])
            if key not in seen:
                seen.add(key)
                data.append((len(at), segments))
    model, squares = Field(), {}
    for _ in range(rounds):
        for n, segments in data:
            scores = [model.score(f) for _, _, f, _ in segments]
            ends: list[list[int]] = [[] for _ in range(n)]
            starts: list[list[int]] = [[] for _ in range(n)]
            for k, (i, j, _, _) in enumerate(segments):
                ends[j].append(k)
                starts[i].append(k)
            ahead, behind = [0.0] * n, [0.0] * n
            for j in range(1, n):
                ahead[j] = ahead[j - 1]
                for k in ends[j]:
                    ahead[j] = _plus(ahead[j], ahead[segments[k][0]] + scores[k])
            for i in range(n - 2, -1, -1):
                behind[i] = behind[i + 1]
                for k in starts[i]:
                    behind[i] = _plus(behind[i], behind[segments[k][1]] + scores[k])
            for (i, j, features, gold), s in zip(segments, scores, strict=True):
                gap = gold - exp(min(0.0, ahead[i] + s + behind[j] - ahead[-1]))
                if abs(gap) < 1e-4:
                    continue
                for f in features:
                    g = gap - decay * model.weights.get(f, 0.0)
                    squares[f] = squares.get(f, 1e-8) + g * g
                    model.weights[f] = model.weights.get(f, 0.0) + rate * g / squares[f] ** 0.5
    return model


def inner(window: str) -> str:
    """A cut window from its first to its last blank between letters, where no entity can be cut; all of it if it has none."""
    blanks = [m.start() for m in re.finditer(r"(?<=[A-Za-z])\s(?=[A-Za-z])", window)]
    return window[blanks[0] : blanks[-1]] if len(blanks) > 1 else window


def learn(docs: DataFrame, windows: int = 1_500, window_bytes: int = 1 << 14, text_col: str = "text") -> Field:
    """A field from the ``windows`` different ones least by a hash among the windows of all texts that hold digits or an @.

    Texts of any length are cut into windows of ``window_bytes``; the ends of a text that was cut are left to where no entity
    is. So the driver holds a bounded sample. Null and empty texts teach nothing; without a window the field is empty
    and adds nothing. Other columns are not read.
    """
    rows = windowed(docs.select(F.col(text_col).alias("text")), "text", window_bytes).where(F.col("text").rlike("[0-9]{5}|@|[0-9][.][0-9]|[+][0-9]|[0-9][ -][0-9]{3}"))
    drawn = thinned(rows, F.col("text"), windows).groupBy(F.xxhash64("text").alias("draw")).agg(F.min("text").alias("text"), F.max("cut").alias("cut"))
    return train([inner(r.text) if r.cut else r.text for r in drawn.orderBy("draw").limit(windows).collect()])


def find(text: str, model: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: the base ones and segments of the field that meet none of these. Sorted by kind, start."""
    base, _ = base_spans(text)
    order = {k: n for n, k in enumerate(ALL_KINDS)}
    base.sort(key=lambda s: (order[s[0]], s[1], s[2]))
    added = []
    if model.weights:
        taken = sorted((a, b) for _, a, b in base)
        k = reach = 0
        for start, stop in regions(text):
            for kind, a, b in decode(text, model, start, stop):
                while k < len(taken) and taken[k][0] < b:
                    reach, k = max(reach, taken[k][1]), k + 1
                if reach <= a:
                    added.append((kind, a, b))
    return base, sorted(base + added, key=lambda s: (order[s[0]], s[1], s[2]))


def told(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def detect(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, counts of base spans by kind, SHA-256 of the base spans, and all spans as ``kind:start:end``.

    Places are code points, ends exclusive. A null or empty text has none. One pass, no shuffle; rows stand for
    themselves, so repeated rows and null ids are answered each; an empty table gives none. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins("personal data")
        for batch in batches:
            counts, digests, spans = {k: [] for k in KINDS}, [], []
            for text in batch.column("text"):
                base, every = find(text.as_py() or "", shared.value)
                for kind in KINDS:
                    counts[kind].append(sum(k == kind for k, _, _ in base))
                digests.append(hashlib.sha256(told(base).encode()).hexdigest())
                spans.append(told(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=[f.split()[0] for f in FOUND.split(", ")],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, FOUND)


def hide(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each run of overlapping spans becomes its first span's kind in brackets."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, model: Field, text_col: str = "text") -> DataFrame:
    """The same rows and columns with all spans hidden. Null texts stay null; texts without spans keep every character."""
    spark = docs.sparkSession
    ship(spark)
    shared, place = spark.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins("personal data")
        for batch in batches:
            texts = [t if not t else hide(t, find(t, shared.value)[1]) for t in (v.as_py() for v in batch.column(place))]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)
