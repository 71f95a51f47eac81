"""Secret scans: fixed patterns, and strings that a tokenizer cannot shorten.

Patterns find assignments of passwords and keys, access key ids and long hexadecimal strings. The
token-efficiency test adds what has no fixed form: a long unbroken string of which a BPE vocabulary,
fitted to ordinary text, needs a token for every one or two characters is random. The whole string is
tested, each of its parts between ``/ _ = + -``, and every stretch of it, so that readable text around
a key does not hide it. Hexadecimal digests of usual lengths, UUIDs and dates are left out first, and so are,
of the test as a whole, names made of words that the vocabulary shortens. Each document is scanned
alone, whole, inside its task.

Defined cases: a null or empty text has no spans; equal rows get equal spans; a text of any length is
scanned whole; offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import functools
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import packed

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run either has 24 characters or fails whole
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"(?=[0-9]*[A-Fa-f])(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}")
PART = re.compile(r"[A-Za-z0-9]+")
CAPITALS = re.compile(r"(?<![A-Za-z0-9])[A-Z]+(?![A-Za-z0-9])")
DATE = r"(?:19|20)[0-9]{2}([-_/]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])(?:[-_T/]?(?:[01][0-9]|2[0-3])[-_]?[0-5][0-9](?:[-_]?[0-5][0-9])?Z?)?"
KNOWN = re.compile(rf"(?<![A-Za-z0-9])(?:{UUID.pattern}|{DATE})(?![A-Za-z0-9])")
SHORTEST = 20
CHARS_PER_TOKEN = 1.9
SPANS = "array<struct<kind: string, first: int, past: int>>"


@functools.cache
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three fixed patterns, each found left to right without overlaps."""
    found = []
    lowered = text.lower()  # only to skip texts without any keyword; offsets come from the text itself
    if any(k in lowered for k in KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _digest(value: str) -> bool:
    return len(value) in DIGEST_LENGTHS and DIGEST.fullmatch(value) is not None


def _segments(value: str) -> list[tuple[int, int]]:
    """What known forms leave of a run: digests, UUIDs and dates between other parts are cut out."""
    gone = [m.span() for m in KNOWN.finditer(value)]
    gone += [m.span() for m in PART.finditer(value) if _digest(m[0])]
    kept, at = [], 0
    for first, past in [*sorted(gone), (len(value), len(value))]:
        if PART.search(value, at, first):
            kept.append((at, first))
        at = max(at, past)
    return kept


def _folded(value: str) -> str:
    """Words in capitals in lower case, as the vocabulary has them."""
    return CAPITALS.sub(lambda m: m[0].lower(), value)


def _named(value: str, encoding: tiktoken.Encoding, chars_per_token: float) -> bool:
    """Names whose parts are words of one case, capitalised words or numbers, and shortened by the vocabulary."""
    parts = PART.findall(value)
    pieces = [NAME_PART.findall(p) for p in parts]
    if any(sum(map(len, found)) < len(p) for found, p in zip(pieces, parts)):
        return False
    size = sum(map(len, parts))
    if sum(map(len, pieces)) * 4 > size:  # words of four letters or more on average
        return False
    return size >= chars_per_token * sum(len(encoding.encode_ordinary(_folded(p))) for p in parts)


def _stretches(value: str, encoding: tiktoken.Encoding, chars_per_token: float) -> list[tuple[int, int]]:
    """Shortest stretches of whole tokens with ``SHORTEST`` letters and digits that the vocabulary does not shorten."""
    at, held = 0, []  # of tokens with letters or digits: place and number of these
    for token in encoding.encode_ordinary(_folded(value)):
        past = at + len(encoding.decode_single_token_bytes(token))
        size = sum(map(len, PART.findall(value, at, past)))
        if size:
            held.append((at, past, size))
        at = past
    found, last, chars = [], 0, 0
    for i, (first, _, size) in enumerate(held):
        while last < len(held) and chars < SHORTEST:
            chars += held[last][2]
            last += 1
        if chars < SHORTEST:
            break
        if chars < chars_per_token * (last - i):
            found.append((first, held[last - 1][1]))
        chars -= size
    return found


def _random_places(value: str, encoding: tiktoken.Encoding, chars_per_token: float) -> list[tuple[int, int]]:
    """Places of a run that the vocabulary does not shorten, apart and in order; the whole run where all of it is."""

    def unshortened(text: str) -> bool:
        return len(text) < chars_per_token * len(encoding.encode_ordinary(_folded(text)))

    segments = _segments(value)
    texts = [value[a:b] for a, b in segments]
    size = sum(map(len, texts))
    tokens = sum(len(encoding.encode_ordinary(_folded(t))) for t in texts)
    if size >= SHORTEST and size < chars_per_token * tokens and not all(_named(t, encoding, chars_per_token) for t in texts):
        return [(0, len(value))]
    found = []
    for (at, _), text in zip(segments, texts):
        parts = [m.span() for m in PART.finditer(text) if m.end() - m.start() >= SHORTEST and unshortened(m[0])]
        found += [(at + a, at + b) for a, b in parts + _stretches(text, encoding, chars_per_token)]
    joined: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if joined and a <= joined[-1][1]:
            a, b = joined[-1][0], max(b, joined.pop()[1])
        joined.append((a, b))
    return joined


def random_spans(text: str, path: str, pattern: str, chars_per_token: float = CHARS_PER_TOKEN) -> list[tuple[str, int, int]]:
    encoding = _encoding(path, pattern)
    return [("random", m.start() + a, m.start() + b) for m in CANDIDATE.finditer(text) for a, b in _random_places(m[0], encoding, chars_per_token)]


def scan(text: str | None, path: str, pattern: str, chars_per_token: float = CHARS_PER_TOKEN) -> list[tuple[str, int, int]]:
    """All spans, by start and then by kind in the order of ``KINDS``."""
    held = text or ""
    found = base_spans(held) + random_spans(held, path, pattern, chars_per_token)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def spans(text: Column, path: str, pattern: str, chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    """Array of ``(kind, first, past)`` of one text column."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("past", pa.int32())]))

    def batch(texts: pa.Array) -> pa.Array:
        rows = [[dict(zip(("kind", "first", "past"), s)) for s in scan(t.as_py(), path, pattern, chars_per_token)] for t in texts]
        return pa.array(rows, kind)

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, SPANS).asNondeterministic()(text)


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlaps joined, replaced by ``mark``."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        kept = F.substring(text, state["at"] + 1, F.greatest(s["first"] - state["at"], F.lit(0)))
        marked = F.when(s["first"] >= state["at"], F.concat(state["done"], kept, F.lit(mark))).otherwise(state["done"])
        return F.struct(marked.alias("done"), F.greatest(state["at"], s["past"]).alias("at"))

    rest = lambda state: F.concat(state["done"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.when(F.size(found) > 0, F.aggregate(found, start, step, rest)).otherwise(text)


def redact(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Every row, its secrets replaced by a mark; a column ``n_chars``, where present, follows the text."""
    marked = packed(docs, found=spans(docs[f"`{text}`"], path, pattern)).withColumn("clean", redacted(F.col(f"row.`{text}`"), F.col("found")))
    changed = F.size("found") > 0
    columns = []
    for c, kind in docs.dtypes:
        value = F.col(f"row.`{c}`")
        if c == text:
            value = F.col("clean")
        elif c == "n_chars":
            value = F.when(changed, F.length("clean").cast(kind)).otherwise(value)
        columns.append(value.alias(c))
    return marked.select(*columns)
