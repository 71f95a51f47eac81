"""Short licence notices in documents, found with a bounded number of edits.

Texts become words of lower-case letters and digits with one space between. A notice may differ from
its phrase in up to a tenth of its characters (Levenshtein edits), say k of them. Cut into k + 1
pieces, at least one piece then stands unchanged (pigeonhole), so one Aho-Corasick pass over the pieces of
all notices finds every candidate; ``regex`` verifies the whole phrase with at most k errors at the
word boundaries around it. Words that tell a notice from its relatives (``mit``, a version) must
stand unchanged. Each document is scanned alone and whole inside its task; nothing is shuffled.

Of places of one notice that overlap, the one with the fewest edits is kept (then the first, then the
shortest); unchanged places are all kept.

Defined cases: a null or empty text has no words and no spans; equal rows get equal spans; a text of
any length is scanned whole in time linear in its length and its candidates; columns of the table do
not matter, as only the text is read; an empty table stays empty. Offsets are code points of the
original text, ends exclusive; words count from 0.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F

ALLOWED_SHARE = 10  # one edit for every so many characters of a phrase
VERDICTS = 50_000  # verified strings kept, none longer than a phrase and its edits


@dataclass(frozen=True)
class Notice:
    label: str
    phrase: str
    keys: tuple[str, ...] = ()  # words that must stand unchanged
    base: bool = False

    @property
    def most(self) -> int:
        """Edits allowed."""
        return len(self.phrase) // ALLOWED_SHARE


# fixed values: wordings of public licences
NOTICES = (
    Notice("mit", "under the mit license", ("mit",), base=True),
    Notice("apache-2", "apache license version 2", ("2",), base=True),
    Notice("cc-by-nc", "cc by nc", base=True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Notice("gpl", "gnu general public license"),
    Notice("lgpl", "gnu lesser general public license", ("lesser",)),
    Notice("agpl", "gnu affero general public license", ("affero",)),
    Notice("mpl-2", "mozilla public license version 2", ("2",)),
    Notice("cc-by-nc", "creative commons attribution noncommercial", ("noncommercial",)),
    Notice("cc-by-nc", "creative commons attribution non commercial", ("non", "commercial")),
    Notice("cc-by-sa", "creative commons attribution sharealike", ("sharealike",)),
    Notice("cc-by-sa", "creative commons attribution share alike", ("share", "alike")),
    Notice("unlicense", "free and unencumbered software released into the public domain"),
    Notice("proprietary", "all rights reserved", ("all", "rights")),
)

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLDED = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 0x20 for c in range(256))
_WORD = regex.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")
_SPAN = [
    ("label", pa.string()), ("phrase", pa.string()), ("base", pa.bool_()), ("errors", pa.int32()), ("similarity", pa.float64()),
    ("first_word", pa.int64()), ("past_word", pa.int64()), ("first", pa.int64()), ("past", pa.int64()),
]
SCANNED = (
    "struct<n_words: long, spans: array<struct<label: string, phrase: string, base: boolean, errors: int, "
    "similarity: double, first_word: long, past_word: long, first: long, past: long>>>"
)


def word_octets(octets: bytes) -> list[bytes]:
    """Words of a UTF-8 text in lower case (A-Z alone)."""
    return octets.translate(_FOLDED).split()


def pieces(phrase: str, count: int) -> list[tuple[int, str]]:
    """``count`` pieces of nearly equal length that make up the phrase, with their offsets."""
    cuts = [i * len(phrase) // count for i in range(count + 1)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Seeds and verifying patterns of some notices."""

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for n, notice in enumerate(notices):
            for offset, piece in pieces(notice.phrase, notice.most + 1):
                seeds.setdefault(piece, []).append((n, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, [(n, offset + len(piece) - 1) for n, offset in uses])
        self.seeds.make_automaton()
        patterns = [regex.compile(f"(?b)(?:{regex.escape(n.phrase, literal_spaces=True)}){{e<={n.most}}}") for n in notices]

        @functools.lru_cache(VERDICTS)
        def errors(n: int, found: str) -> int | None:
            """Edits between a phrase and a string; None beyond those allowed, or where a key word is missing."""
            if not set(notices[n].keys).issubset(found.split(" ")):
                return None
            match = patterns[n].fullmatch(found)
            return sum(match.fuzzy_counts) if match else None

        self.errors = errors

    def _verified(self, line: str) -> set[tuple[int, int, int, int]]:
        """(notice, errors, first, past) of all word-aligned places with a seed; ``line`` has a space at both ends."""
        found, tried = set(), set()
        for at, uses in self.seeds.iter(line):
            for n, offset in uses:
                notice = self.notices[n]
                start = at - offset
                if (n, start) in tried:
                    continue
                tried.add((n, start))
                most = notice.most
                low = max(1, start - most)
                if any(line.find(k, low, start + len(notice.phrase) + 2 * most) < 0 for k in notice.keys):
                    continue
                for first in range(low, start + most + 1):
                    if line[first - 1 : first] != " ":
                        continue
                    for past in range(first + len(notice.phrase) - most, min(first + len(notice.phrase) + most, len(line) - 1) + 1):
                        if line[past] == " ":
                            errors = self.errors(n, line[first:past])
                            if errors is not None:
                                found.add((n, errors, first, past))
        return found

    def _apart(self, found: set[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Without the changed places that overlap a better one of the same notice."""
        kept: list[tuple[int, int, int, int]] = []
        for n in {f[0] for f in found}:
            # places of one notice that overlap each other, in turn
            own = sorted((f for f in found if f[0] == n), key=lambda f: f[2:])
            while own:
                reach, size = own[0][3], 1
                while size < len(own) and own[size][2] < reach:
                    reach, size = max(reach, own[size][3]), size + 1
                chosen: list[tuple[int, int, int, int]] = []
                for f in sorted(own[:size], key=lambda f: f[1:]):
                    if f[1] == 0 or all(f[3] <= c[2] or c[3] <= f[2] for c in chosen):
                        chosen.append(f)
                kept += chosen
                del own[:size]
        return sorted(kept, key=lambda f: (f[2], f[3], f[0]))

    def scan(self, octets: bytes) -> tuple[int, list[tuple]]:
        """Number of words, and the spans of one text."""
        words = word_octets(octets)
        line = f" {b' '.join(words).decode()} "
        kept = self._apart(self._verified(line))
        spans = []
        if kept:
            places = [m.span() for m in _WORD.finditer(octets.decode())]
            at = word = 0
            for n, errors, first, past in kept:
                notice = self.notices[n]
                word += line.count(" ", at, first)
                at = first
                size = line.count(" ", first, past) + 1
                similarity = 1.0 - errors / len(notice.phrase)
                ends = places[word - 1][0], places[word + size - 2][1]
                spans.append((notice.label, notice.phrase, notice.base, errors, similarity, word - 1, word - 1 + size, *ends))
        return len(words), spans


@functools.cache
def scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def find(text: Column, notices: tuple[Notice, ...] = NOTICES) -> Column:
    """Struct of ``n_words`` and ``spans``: label, phrase, edits, words and code points of every notice found."""
    names = [name for name, _ in _SPAN]
    rows = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct(_SPAN)))])

    def batch(texts: pa.Array) -> pa.Array:
        search = scanner(notices)
        found = []
        for text in texts.cast(pa.binary()):
            n_words, spans = search.scan(text.as_py() or b"")
            found.append({"n_words": n_words, "spans": [dict(zip(names, s)) for s in spans]})
        return pa.array(found, rows)

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, SCANNED).asNondeterministic()(text)
