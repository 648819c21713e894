"""Secrets by the cost of guessing them.

Three strict patterns give the base spans, which always stay. Further candidates are values in a
credential context: what follows a credential word and a separator, and the password of an
address with a user. For each the cheapest way to guess it is found by dynamic programming over its
segmentations: into dictionary words, dates, repeats of what came just before, walks over
the keyboard or the alphabet, and brute force. A value that costs ``MIN_BITS`` or more is a
secret; "required" or "qwerty123" after a "password:" is not.

The cost of a segment in bits (each segment costs ``SEGMENT_BITS`` besides):

* a word: log2 of its rank in a public vocabulary, 1 for a leading capital or capitals only, else 1 for
  each capital; 1 for each digit or sign in a letter's place;
* a date (day, month and year in a usual order, with or without separators): 17, with separators 19;
  a year from 1900 to 2099: 8;
* a repeat of the last 1 to ``MAX_UNIT`` characters, as often as need be: log2 of the unit, and 6;
* a walk of 3 or more keys: 9, and 3 for each change of direction;
* brute force: log2 of the size of each character's class.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavlake.llm.scratch import ship_by_value, small_batches

#: A vocabulary with word ends (JSON of the tokenizers library), most frequent words first.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: 10**8 guesses: the least cost of a secret.
MIN_BITS = 8 * math.log2(10)
SEGMENT_BITS, DATE_BITS, DATE_SIGN_BITS, YEAR_BITS, REPEAT_BITS, WALK_BITS, TURN_BITS = 1.0, 17.0, 2.0, 8.0, 6.0, 9.0, 3.0
MAX_UNIT, LEAST_WORD, LEAST_WALK = 8, 3, 3

#: Base kinds in order: fixed values. Letters of the first are ASCII in either case.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
BASE, ADDED = ("assign", "access", "hex"), "value"

#: Values in a credential context.
_WORDS = (r"pass(?:word|wd|phrase|code)|secret|token|(?:api|access|private)[ _-]?key|credentials?"
          r"|(?<![A-Za-z])(?:pwd|pin|auth(?:orization)?|bearer|login)")
CONTEXTS = (
    re.compile(rf"(?:{_WORDS})[\"']?\x20*(?::=|=>|[:=])\x20*(?:\"([^\"\s]+)\"|'([^'\s]+)'|([^\s\"'<>(){{}},;]+))",
               re.IGNORECASE | re.ASCII),
    re.compile(rf"(?:{_WORDS})\x20is\x20([^\s\"'<>(){{}},;]+)", re.IGNORECASE | re.ASCII),
    re.compile(r"bearer\x20([A-Za-z0-9+/_.~=-]+)", re.IGNORECASE | re.ASCII),
    re.compile(r"://[^\s/:@\"'<>]+:([^\s/@\"'<>]+)@"),
)

_LOWER = {c: c + 32 for c in range(65, 91)}
_SIGNS = {"@": "a", "4": "a", "0": "o", "1": "l", "!": "i", "3": "e", "$": "s", "5": "s", "7": "t"}
_PLAIN = str.maketrans(_SIGNS)
#: Where keys are: fixed values. The alphabet is a board of one row.
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_KEYS = {ch: (x, y) for y, row in enumerate(_ROWS) for x, ch in enumerate(row)}
_DATES = re.compile(r"(?:(?P<y>(?:19|20)\d\d)(?P<s>[-/._]?)(?P<m>0[1-9]|1[0-2])(?P=s)(?P<d>0[1-9]|[12]\d|3[01])"
                    r"|(?P<a>0[1-9]|[12]\d|3[01])(?P<t>[-/._]?)(?P<b>0[1-9]|[12]\d|3[01])(?P=t)(?:19|20)\d\d)",
                    re.ASCII)


def read_words(path: str = VOCABULARY) -> dict[str, float]:
    """Lower-case words of three letters or more and the bits of their ranks."""
    try:
        with open(path, encoding="utf-8") as file:
            pieces = json.load(file)["model"]["vocab"]
    except FileNotFoundError as e:
        raise FileNotFoundError(f"the vocabulary {path} is missing; give another by its path") from e
    ranked = sorted((rank, p.removesuffix("</w>")) for p, rank in pieces.items() if p.endswith("</w>"))
    words = [w for _, w in ranked if len(w) >= LEAST_WORD and w.isascii() and w.isalpha()]
    return {w: math.log2(k + 1) for k, w in enumerate(words, 1)}


def char_bits(ch: str) -> float:
    """log2 of the size of the character's class."""
    if "0" <= ch <= "9":
        return math.log2(10)
    if "a" <= ch <= "z" or "A" <= ch <= "Z":
        return math.log2(26)
    return math.log2(33) if ch.isascii() else math.log2(100)


def word_bits(segment: str, words: dict[str, float]) -> float | None:
    """Bits of a segment as a dictionary word, with signs for letters and capitals."""
    lower = segment.translate(_LOWER)
    plain = lower.translate(_PLAIN)
    if lower in words:
        rank, signs = words[lower], 0
    elif plain in words:
        rank, signs = words[plain], sum(a != b for a, b in zip(lower, plain, strict=True))
    else:
        return None
    capitals = sum("A" <= ch <= "Z" for ch in segment)
    if capitals and (capitals == len(segment) or (capitals == 1 and "A" <= segment[0] <= "Z")):
        capitals = 1
    return rank + signs + capitals


def date_bits(segment: str) -> float | None:
    if len(segment) == 4:
        return YEAR_BITS if segment.isascii() and segment.isdigit() and segment[:2] in ("19", "20") else None
    m = _DATES.fullmatch(segment)
    if not m:
        return None
    if m["a"] and int(m["a"]) > 12 and int(m["b"]) > 12:
        return None
    return DATE_BITS + (DATE_SIGN_BITS if m["s"] or m["t"] else 0)


def step(a: str, b: str) -> list[tuple]:
    """Directions in which the key ``b`` is next to ``a``, on the keyboard and in the alphabet."""
    a, b = a.translate(_LOWER), b.translate(_LOWER)
    out = []
    if a in _KEYS and b in _KEYS:
        (x, y), (u, v) = _KEYS[a], _KEYS[b]
        # rows are shifted by half a key: up-right and down-left neighbours are next to each other
        if (u - x, v - y) in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)):
            out.append(("key", u - x, v - y))
    if "a" <= a <= "z" and "a" <= b <= "z" and abs(ord(a) - ord(b)) == 1:
        out.append(("letter", ord(b) - ord(a), 0))
    return out


def guess_bits(value: str, words: dict[str, float], longest: int) -> float:
    """Bits of the cheapest segmentation, in time proportional to the value's length.

    Words and dates have bounded lengths; brute force, repeats and walks go on from one character to
    the next, so they are states: of brute force, of each unit, of each direction.
    """
    far = math.inf
    n = len(value)
    lower = value.translate(_LOWER)
    plain = lower.translate(_PLAIN)
    longest = max(longest, 10)  # a date's length
    best = [far] * (n + 1)
    best[0] = 0.0
    brute = far
    copies = [far] * (MAX_UNIT + 1)
    walks: dict[tuple, float] = {}
    begun: dict[tuple, float] = {}  # walks of two keys, one too few
    for j in range(1, n + 1):
        ch = value[j - 1]
        now = brute = min(brute, best[j - 1] + SEGMENT_BITS) + char_bits(ch)
        for unit in range(1, min(MAX_UNIT, j - 1) + 1):
            if value[j - 1 - unit] == ch:
                copies[unit] = min(copies[unit], best[j - 1] + SEGMENT_BITS + REPEAT_BITS + math.log2(unit))
                now = min(now, copies[unit])
            else:
                copies[unit] = far
        if j > 1:
            after, start = {}, {}
            for way in step(value[j - 2], ch):
                start[way] = best[j - 2] + SEGMENT_BITS + WALK_BITS
                paths = [cost + (TURN_BITS if other != way else 0) for known in (walks, begun)
                         for other, cost in known.items() if other[0] == way[0]]
                if paths:
                    after[way] = min(paths)
                    now = min(now, after[way])
            walks, begun = after, start
        for size in range(LEAST_WORD, min(longest, j) + 1):
            i = j - size
            if best[i] + SEGMENT_BITS >= now:
                continue
            if lower[i:j] in words or plain[i:j] in words:
                now = min(now, best[i] + SEGMENT_BITS + word_bits(value[i:j], words))
            if size in (4, 8, 10):
                bits = date_bits(value[i:j])
                if bits is not None:
                    now = min(now, best[i] + SEGMENT_BITS + bits)
        best[j] = now
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, value) of the base spans, in order."""
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def context_values(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values in a credential context, without closing punctuation."""
    found = set()
    for pattern in CONTEXTS:
        for m in pattern.finditer(text):
            group = m.lastindex
            start, end = m.span(group)
            if group == pattern.groups:  # not a quoted one
                while end > start and text[end - 1] in ".:!?":
                    end -= 1
            if end > start:
                found.add((start, end))
    return sorted(found)


def secrets_of(text: str, words: dict[str, float], longest: int, min_bits: float = MIN_BITS):
    """(kind, start, end, bits) of all spans of a text by start, then kind; bits of the value guessed."""
    base = base_spans(text)
    out = [(start, kind, end, guess_bits(value, words, longest)) for start, kind, end, value in base]
    covered = sorted((start, end) for start, _, end, _ in base)
    # spans overlap within a kind never and between kinds seldom; a running end makes them disjoint
    reach, merged = -1, []
    for start, end in covered:
        if start < reach:
            merged[-1] = (merged[-1][0], max(reach, end))
        else:
            merged.append((start, end))
        reach = merged[-1][1]
    at, last = 0, -1
    for start, end in context_values(text):
        while at < len(merged) and merged[at][1] <= start:
            at += 1
        if (at < len(merged) and merged[at][0] < end) or start < last:
            continue
        bits = guess_bits(text[start:end], words, longest)
        if bits >= min_bits:
            out.append((start, len(BASE), end, bits))
            last = end
    kinds = (*BASE, ADDED)
    return [(kinds[k], start, end, bits) for start, k, end, bits in sorted(out)]


def _redacted(text: str, spans) -> str:
    out, at = [], 0
    for kind, start, end, _ in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, words: dict[str, float] | None = None,
                 min_bits: float = MIN_BITS) -> DataFrame:
    """(doc_id, secrets) per row: array of (kind, start, end, bits), code points, end exclusive.

    Bits are the cost of guessing: of an assignment's value, of the whole span else. Null and empty texts
    have none; repeated rows count each; other columns are not read. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    words = read_words() if words is None else words
    longest = max(map(len, words), default=0)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("bits", pa.float64())]))

    def find(batches):
        for batch in batches:
            rows = [[{"kind": k, "start": s, "end": e, "bits": b} for k, s, e, b in
                     secrets_of(t or "", words, longest, min_bits)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "secrets"])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        find, f"doc_id {doc_id}, secrets array<struct<kind: string, start: int, end: int, bits: double>>")


def redact_secrets(docs: DataFrame, words: dict[str, float] | None = None,
                   min_bits: float = MIN_BITS) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; all columns stay."""
    small_batches(docs.sparkSession)
    words = read_words() if words is None else words
    longest = max(map(len, words), default=0)
    at = docs.columns.index("text")

    def redact(batches):
        for batch in batches:
            texts = [None if t is None else _redacted(t, secrets_of(t, words, longest, min_bits))
                     for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(redact, docs.schema)


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_value, weakest_bits) per row.

    Counts and digest of the base spans; all spans as kind:start:end, by start and then kind; the
    values added, and the least bits of an assignment's or added value (null without one).
    """
    small_batches(docs.sparkSession)
    words = read_words()
    longest = max(map(len, words))

    def report(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                spans = secrets_of(text or "", words, longest)
                shown = [f"{k}:{s}:{e}" for k, s, e, _ in spans]
                kinds = [k for k, _, _, _ in spans]
                base = ",".join(x for x, k in zip(shown, kinds, strict=True) if k != ADDED)
                bits = [b for k, _, _, b in spans if k in ("assign", ADDED)]
                rows.append((*map(kinds.count, BASE), hashlib.sha256(base.encode()).hexdigest(), ",".join(shown),
                             kinds.count(ADDED), min(bits, default=None)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_value", "weakest_bits"])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        report, f"doc_id {doc_id}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
                "spans string, n_value bigint, weakest_bits double")


ship_by_value(__name__)
