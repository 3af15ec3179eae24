"""Fuzzy search for short licence notices.

The text is lower-cased (A-Z) and reduced to its words, joined by one space. A
notice may differ from its pattern in up to ``k`` edits. Cut into ``k + 1``
pieces, at least one piece must stand in the text unchanged (pigeonhole): an
Aho-Corasick automaton over all pieces gives the candidate places, and the
regex library's bounded-error matching verifies the few bytes around each,
reporting span and edits. Edits count in UTF-8 bytes. A span begins and ends at
a word's border, and must hold the pattern's names (words of at most three
letters that are no common words: ``mit``, ``gnu``) unchanged: one edit turns
``kit`` into ``mit``.

*Base* phrases are counted where their words stand consecutively, i.e. where a
verified span has no edit and whole words.

Whole texts are searched. A null or empty text has no words and no place.
Repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import remembered, small_batches

#: Phrases whose every place is counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notices, their labels and the edits allowed.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("released under the mit license", "mit", 3),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("gnu general public license", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("mozilla public license", "mpl", 2),
    ("eclipse public license", "epl", 2),
    ("redistribution and use in source and binary forms", "bsd", 5),
    ("neither the name of the copyright holder nor the names of its contributors", "bsd", 6),
    ("creative commons attribution", "cc-by", 3),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6),
    ("all rights reserved", "proprietary", 1),
]
BASE_EDITS = 1
COMMON = set("a and any in is nor not of or the to use all 2 0".split())
RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label string, first_word long, n_words long, edits int>>"
)
#: To lower case, and every byte that belongs to no word to a space.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class Scanner:
    def __init__(self, base: dict[str, str], notices: list[tuple[str, str, int]]):
        import ahocorasick

        self.patterns = [(p, label, BASE_EDITS, True) for p, label in base.items()]
        self.patterns += [(p, label, k, False) for p, label, k in notices]
        self.matchers = [regex.compile(f"(?b)(?<![^ ])(?:{regex.escape(p)}){{e<={k}}}(?![^ ])") for p, _, k, _ in self.patterns]
        self.names = [{w for w in p.split() if len(w) <= 3 and w not in COMMON} for p, _, _, _ in self.patterns]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for n, (p, _, k, _) in enumerate(self.patterns):
            cuts = [len(p) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(p[a:b], []).append((n, a))
        self.automaton = ahocorasick.Automaton()
        for s, uses in seeds.items():
            self.automaton.add_word(s, (len(s), uses))
        self.automaton.make_automaton()

    def verify(self, n: int, words: str, guess: int) -> tuple[int, int, int] | None:
        """The best span around ``guess``, where the pattern would begin: start, end, edits."""
        p, _, k, _ = self.patterns[n]
        low, high = max(0, guess - k), min(len(words), guess + len(p) + k)
        m = self.matchers[n].search(words, low, high)
        if not m or words[m.end() : m.end() + 1] not in ("", " "):  # the search takes its own end for a border
            return None
        if not self.names[n] <= set(words[m.start() : m.end()].split(" ")):
            return None
        return m.start(), m.end(), sum(m.fuzzy_counts)

    def scan(self, text: str | None) -> dict:
        tokens = (text or "").encode().translate(WORDS).split()
        words = b" ".join(tokens).decode("latin-1")
        found: dict[tuple[int, int, int], int] = {}
        tried: set[tuple[int, int]] = set()
        exact: set[tuple[int, int]] = set()
        for end, (width, uses) in self.automaton.iter(words):
            for n, offset in uses:
                guess = end - width + 1 - offset
                if (n, guess) in tried:
                    continue
                tried.add((n, guess))
                p, _, _, is_base = self.patterns[n]
                if (span := self.verify(n, words, guess)) is None:
                    continue
                found[n, span[0], span[1]] = span[2]
                stop = guess + len(p)
                if (
                    is_base
                    and words.startswith(p, max(guess, 0))
                    and guess >= 0
                    and (guess == 0 or words[guess - 1] == " ")
                    and (stop == len(words) or words[stop] == " ")
                ):
                    exact.add((guess, n))
        at = passed = 0
        word_at: dict[int, int] = {}
        for position in sorted({g for g, _ in exact} | {a for _, a, _ in found}):
            passed += words.count(" ", at, position)
            at = position
            word_at[position] = passed
        places = sorted(word_at[g] for g, _ in exact)
        base = {self.patterns[n][1] for _, n in exact}
        labels = base | {self.patterns[n][1] for n, _, _ in found}
        return {
            "n_words": len(tokens),
            "n_base": len(places),
            "first_word": places[0] if places else None,
            "last_word": places[-1] if places else None,
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)),
            "score": max((1 - e / len(self.patterns[n][0]) for (n, _, _), e in found.items()), default=0.0),
            "spans": [
                {
                    "label": self.patterns[n][1],
                    "first_word": word_at[a],
                    "n_words": words.count(" ", a, b) + 1,
                    "edits": e,
                }
                for (n, a, b), e in sorted(found.items(), key=lambda x: (x[0][1], x[0][2], x[0][0]))
            ],
        }


def license_column(text: Column, base: dict[str, str] | None = None, notices=None) -> Column:
    """A struct of what :class:`Scanner` finds in ``text``."""
    base = BASE if base is None else base
    notices = NOTICES if notices is None else notices
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_type

    kind = StructType.fromDDL(RESULT)
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def scan(texts: pa.Array) -> pa.Array:
        scanner = remembered(("licenses", str(base), str(notices)), lambda: Scanner(base, notices))
        return pa.array([scanner.scan(t.as_py()) for t in texts], arrow)

    return scan(text.cast("string"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans`` per row."""
    return small_batches(docs).select(
        F.col(id_col).alias("doc_id"), license_column(F.col(text_col), **how).alias("found")
    ).select("doc_id", "found.*")
