"""Exact byte-level BPE by backtracking, and decoding by an offset table.

Encoding a piece (what the pre-tokenizer splits off) works left to right. An
Aho-Corasick automaton over all tokens gives the longest token that starts at
each byte, in one pass. The encoder appends the longest token whose pair with
the token before it is *compatible*: encoding the two tokens' bytes together
would give back just these two. If none fits, it steps back one token and tries
that token's next shorter prefix; a byte position that failed once is never
entered again, so the work is linear in the piece. A sequence in which every
neighbouring pair is compatible is the very result of applying the merges in
rank order. Compatibility is found by undoing merges along the border of the
two tokens and is remembered in a table.

Decoding concatenates slices of one byte blob, addressed by token id through a
table of offsets, and reads the result as UTF-8.

Null text encodes as the empty text, which has no tokens; a null id list
decodes to the empty text. Long texts are split into pieces first, so nothing
grows with more than the text itself. Repeated rows give repeated results.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import remembered, small_batches

PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes do not depend on the Unicode version; others are split by the library.
SETTLED = "\x00-՗֐-ࢇऀ-౛Ḁ-ỿ -⁯℀-⅏←-⋿　-ヿ一-鿿가-힣"
REMEMBERED = 350_000
DECODED = 1 << 20
SHIFT = 24  # a pair of tokens as one number
ENDINGS = (".", ",", ";", ":", "!", "?")  # each is a piece of its own after a letter
OTHER_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and c not in (0x20, 0x0A))


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Spaced(dict):
    """word -> packed ids of the word with a space before it, found when first asked for.

    Two generations, each of at most ``REMEMBERED`` words: frequent words move
    to the new one before the old one is dropped.
    """

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe, self.old = bpe, {}

    def __missing__(self, word: str) -> bytes:
        if (ids := self.old.get(word)) is None:
            bpe = self.bpe
            plain = word.isascii() or not bpe.unsettled.search(word)
            if plain and word.isalpha():
                ids = bpe.encode_piece(" " + word)
            elif plain and word[-1:] in ENDINGS and word[:-1].isalpha():
                ids = self[word[:-1]] + bpe.endings[word[-1]]
                if len(word) > 7:
                    return ids
            elif plain and word.count("\n") == 1 and word[0] != "\n" and word[-1] != "\n":
                # A line end between two characters that are no white space is a piece.
                before, after = word.split("\n")
                return self[before] + bpe.endings["\n"] + bpe.encode_plain(after)
            else:
                return bpe.encode_plain(" " + word)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        if len(word) < 64:
            self[word] = ids
        return ids


class Bpe:
    """A byte-level BPE vocabulary, ready to encode and decode."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path} holds no byte-level BPE vocabulary")
        to_byte = byte_alphabet()
        as_latin = lambda s: "".join(chr(to_byte[c]) for c in s)  # noqa: E731  one character per byte
        ids = {as_latin(s): i for s, i in spec["model"]["vocab"].items()}
        self.size = max(ids.values()) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.order: dict[int, int] = {}  # pair -> order of its merge
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> (order, left, right)
        for order, (a, b) in enumerate(merges):
            a, b = as_latin(a), as_latin(b)
            self.order[ids[a] << SHIFT | ids[b]] = order
            self.parts.setdefault(ids[a + b], (order, ids[a], ids[b]))
        self.automaton = ahocorasick.Automaton()
        for s, i in ids.items():
            self.automaton.add_word(s, (i, len(s) - 1))
        self.automaton.make_automaton()
        self.length = [0] * self.size
        self.shorter = [-1] * self.size  # token -> longest token that is a proper prefix of it
        for s, i in ids.items():
            self.length[i] = len(s)
            for n in range(len(s) - 1, 0, -1):
                if (j := ids.get(s[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = regex.compile(PIECES)
        self.unsettled = re.compile(f"[^{SETTLED}]")
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.fits: dict[int, bool] = {}  # the pair-compatibility table, filled when first asked for
        self.known: dict[str, bytes] = {}  # piece -> its ids, packed
        self.spaced = Spaced(self)
        self.endings = {c: self.encode_piece(c) for c in [*ENDINGS, "\n"]}
        # The offset table: bytes of token i stand at blob[start[i]:start[i + 1]].
        shown = {i: s.encode("latin-1") for s, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.table_size = max(shown) + 1
        lengths = np.zeros(self.table_size + 1, np.int64)
        for i, s in shown.items():
            lengths[i + 1] = len(s)
        self.start = np.cumsum(lengths).astype(np.int32)
        self.width = np.diff(self.start)
        self.blob = np.frombuffer(b"".join(shown.get(i, b"") for i in range(self.table_size)), np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` as they are when they stand together.

        Undo merges on both sides of the border, latest first. A merge across
        the border that comes before the merge undone there would have
        happened earlier, and torn one of the two tokens apart.
        """
        before = len(self.order)  # the order of the merge undone last
        a, b = left, right
        answer = True
        while True:
            crossing = self.order.get(a << SHIFT | b)
            # Of equal orders, the pair further left is merged first: see below.
            if crossing is not None and crossing < before:
                answer = False
                break
            x, y = self.parts.get(a), self.parts.get(b)
            if x is None and y is None:
                break
            if y is None or (x is not None and x[0] > y[0]):
                before, a = x[0], x[2]
            else:
                # The token right of the border was made by merge y; a crossing of the
                # same order stands further left and would have come first.
                before, b = y[0] + 1, y[1]
        if len(self.fits) > REMEMBERED:
            self.fits.clear()
        self.fits[left << SHIFT | right] = answer
        return answer

    def encode_piece(self, piece: str) -> bytes:
        """The ids of a piece, as packed 32-bit numbers."""
        s = piece if piece.isascii() else piece.encode().decode("latin-1")
        n = len(s)
        longest = [0] * n
        for end, (token, more) in self.automaton.iter(s):
            longest[end - more] = token  # ends only grow, so the longest stays
        known, length, shorter = self.fits.get, self.length, self.shorter
        dead = bytearray(n + 1)
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            end = at + length[token]
            if not dead[end]:
                if last < 0 or (fits := known(last << SHIFT | token)):
                    fits = True
                elif fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    out.append(token)
                    if end == n:
                        return array("i", out).tobytes()
                    at, last, token = end, token, longest[end]
                    continue
            while (cut := shorter[token]) < 0:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
            token, last = cut, out[-1] if out else -1

    def split(self, text: str) -> list[str]:
        if self.unsettled.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.pieces.findall(text)

    def encode_plain(self, text: str) -> bytes:
        """The packed ids of a text that holds no special string."""
        known, out = self.known, []
        if text.isalpha() and text.isascii():
            pieces = [text]
        else:
            pieces = self.split(text)
        for p in pieces:
            if p[0] == " " and p[1:].isalpha() and (p.isascii() or not self.unsettled.search(p)):
                ids = self.spaced[p[1:]]
            elif (ids := known.get(p)) is None:
                ids = self.encode_piece(p)
                if len(known) < REMEMBERED // 4 and len(p) < 64:
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text``; special strings in it become their own ids."""
        parts = self.split_special.split(text) if any(s in text for s in self.special) else [text]
        out: list[bytes] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(array("i", [self.special[part]]).tobytes())
                continue
            words = part.split(" ")
            if "" in words or "\n \n" in part or any(c in part for c in OTHER_SPACES):
                out.append(self.encode_plain(part))
            else:
                # White space stands alone here but for line ends, so every space begins
                # a piece, and words can be looked up with the space before them.
                out.append(self.encode_plain(words[0]))
                out.extend(map(self.spaced.__getitem__, words[1:]))
        if len(self.known) >= REMEMBERED // 4:
            self.known.clear()
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Slices of the blob, joined; ids that the vocabulary lacks stand for nothing."""
        if not len(ids):
            return ""
        if ids.min() < 0 or ids.max() >= self.table_size:
            ids = ids[(ids >= 0) & (ids < self.table_size)]
        return b"".join(
            self.decode_bytes(ids[at : at + DECODED]) for at in range(0, len(ids), DECODED)
        ).decode("utf-8", "replace")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        width = self.width[ids]
        ends = np.cumsum(width, dtype=np.int32)
        where = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        where += np.repeat(self.start[ids] - (ends - width), width)
        return self.blob[where].tobytes()


def load(path: str) -> Bpe:
    return remembered(("bpe", path), lambda: Bpe(path))


def encode_column(text: Column, vocabulary: str) -> Column:
    """The token ids of ``text`` as ARRAY<INT>."""

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def encode(texts: pa.Array) -> pa.Array:
        bpe = load(vocabulary)
        flat, ends = [], np.zeros(len(texts) + 1, np.int32)
        for k, t in enumerate(texts):
            ids = bpe.encode(t.as_py() or "")
            flat.append(ids)
            ends[k + 1] = ends[k] + len(ids)
        values = np.concatenate(flat) if flat else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))

    return encode(F.coalesce(text.cast("string"), F.lit("")))


def round_trip_column(text: Column, vocabulary: str) -> Column:
    """A struct of the token ids of ``text`` and of the text decoded from these ids.

    One function for both, as two chained ones would be planned to encode twice.
    """
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    @F.arrow_udf(kind)
    def both(texts: pa.Array) -> pa.Array:
        bpe = load(vocabulary)
        lists = [bpe.encode(t.as_py() or "") for t in texts]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        values = np.concatenate(lists) if lists else np.empty(0, np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))
        return pa.StructArray.from_arrays([ids, pa.array([bpe.decode(x) for x in lists], pa.string())], ["ids", "decoded"])

    return both(F.coalesce(text.cast("string"), F.lit("")))


def decode_column(ids: Column, vocabulary: str) -> Column:
    """The text that a list of token ids stands for."""

    @F.arrow_udf(T.StringType())
    def decode(lists: pa.Array) -> pa.Array:
        bpe = load(vocabulary)
        return pa.array([bpe.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in lists], pa.string())

    return decode(ids)


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False
) -> DataFrame:
    """``doc_id, ids, n_tokens`` per row, with ``decode`` also ``decoded``; no shuffle, no state beyond the row."""
    docs = small_batches(docs)
    if decode:
        both = docs.select(F.col(id_col).alias("doc_id"), round_trip_column(F.col(text_col), vocabulary).alias("both"))
        return both.select("doc_id", "both.*").withColumn("n_tokens", F.size("ids").cast("long"))
    return docs.select(
        F.col(id_col).alias("doc_id"), encode_column(F.col(text_col), vocabulary).alias("ids")
    ).withColumn("n_tokens", F.size("ids").cast("long"))


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``."""
    return encoded.withColumn("decoded", decode_column(F.col("ids"), vocabulary))


def with_digests(decoded: DataFrame) -> DataFrame:
    """Adds SHA-256 digests of the ids (decimal, joined by commas) and of the decoded text."""
    return decoded.withColumn(
        "ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    ).withColumn("decoded_sha256", F.sha2(F.col("decoded").cast("binary"), 256))
