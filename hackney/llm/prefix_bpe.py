"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

Merges by rank have a local description: a row of tokens is the encoding of its bytes if and only if its
first token encodes itself and each two neighbours are the encoding of their own concatenation, since
the merge that would cross a border is the same with or without what lies further off. Encodings of
prefixes are therefore unique, and the last token of each prefix of a text says all: a token that ends
at position i is the last one of that prefix if it is compatible with the last one of the prefix before
it. Exactly one candidate is, so a position is filled by trying the vocabulary's tokens that end there, as
an automaton names them, and the encoding is read off backwards.

Nothing that is stored for a prefix depends on what follows. So text can be appended exactly, by filling
the positions added, and an edit is re-encoded from the piece it touches up to the first piece border
after it that was a border before (`Encoded`).

Texts are split by the vocabulary's pattern first, and pieces are encoded separately; encodings of pieces
seen before, and of words between single spaces, are kept in tables of bounded size. The pattern looks only forward and `AHEAD` characters
past a piece at most, so long texts are split in windows. A piece that is a token itself gets that
token, as in the library that these files are made for.

Defined results: a null text is an empty one and has no tokens. Ids may be null or repeated; each row is
encoded on its own. Decoding joins the bytes of the tokens, which need not be UTF-8 if ids are cut out
of a document; null or empty ids give no bytes, an id outside the vocabulary is an error. Empty tables
give no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hackney.llm.common import pick

RANKS = "byte_bpe_multi_50k.tiktoken"
WINDOW = 1 << 20  # characters that are split at once
AHEAD = 3  # characters that may be looked at past the end of a piece
MAX_PIECES, MAX_WORDS, MAX_PAIRS = 200_000, 700_000, 500_000  # kept in a worker; some 250 MB
#: A piece begins with a space before what is no white space, whatever lies around; Python's white space
#: holds all that Unicode's does.
_WORD = re.compile(r" (?=\S)")
BATCH = 16 << 20  # characters of text whose ids leave the task together
DECODED = 4 << 20  # ids that are decoded at once


def pattern_of(text: str) -> regex.Pattern:
    r"""The pattern with white space as Unicode has it: `\s` of Python also holds U+001C to U+001F."""
    return regex.compile(text.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class _Kept(dict):
    """Ids by text, as bytes of 32-bit integers; those of a new text are worked out."""

    def __init__(self, work_out: Callable[[str], bytes], limit: int):
        self.work_out, self.limit = work_out, limit

    def __missing__(self, text: str) -> bytes:
        ids = self.work_out(text)
        if len(self) >= self.limit:
            self.clear()
        if len(ids) < 256:
            self[text] = ids
        return ids


class Vocabulary:
    """Tokens by rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        # Finds all tokens that end at a position, the longest first; bytes stand as characters.
        self.endings = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.endings.add_word(token.decode("latin-1"), (rank, len(token)))
        self.endings.make_automaton()
        self.longest = max(map(len, self.ranks))
        self.sizes = [len(token or b"") for token in self.tokens]
        self.packed = [array("i", [rank]).tobytes() for rank in range(size)]
        self.pattern = pattern_of(pattern)
        self.compatible: dict[int, bool] = {}
        self.pieces = _Kept(self.piece_ids, MAX_PIECES)
        self.words = _Kept(self.word_ids, MAX_WORDS)

    def merged(self, text: bytes) -> list[bytes]:
        """The merges of a short text, one by one: the least rank first, then the leftmost."""
        parts = [text[i : i + 1] for i in range(len(text))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether `token` may follow `before`, or begin a piece where that is -1."""
        key = before * len(self.tokens) + token
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) >= MAX_PAIRS:
                self.compatible.clear()
            row = [self.tokens[t] for t in (before, token) if t >= 0]
            known = self.compatible[key] = self.merged(b"".join(row)) == row
        return known

    def extend(self, last: list[int], text: bytes) -> list[int]:
        """Add to `last`, the last tokens of the prefixes of a part of `text`, those of its other prefixes.

        `last[i]` belongs to the prefix of i + 1 bytes.
        """
        known, size = self.compatible.get, len(self.tokens)
        done = len(last)
        # Tokens that end at the first position to fill begin this far before it at most.
        begin = max(0, done + 1 - self.longest)
        for at, (token, length) in self.endings.iter(text[begin:].decode("latin-1")):
            end = begin + at
            if end == done and length <= end + 1:
                before = last[end - length] if length <= end else -1
                fits = known(before * size + token)
                if fits or fits is None and self.fits(before, token):
                    last.append(token)
                    done += 1
        if done < len(text):
            raise ValueError(f"no token ends {text[max(0, done - 31):done + 1]!r}")
        return last

    def read_back(self, last: list[int]) -> list[int]:
        """The encoding of the longest prefix."""
        ids = []
        end = len(last)
        while end:
            ids.append(last[end - 1])
            end -= self.sizes[ids[-1]]
        ids.reverse()
        return ids

    def piece_ids(self, piece: str) -> bytes:
        raw = piece.encode()
        token = self.ranks.get(raw)
        if token is not None:
            return self.packed[token]
        return b"".join([self.packed[t] for t in self.read_back(self.extend([], raw))])

    def word_ids(self, word: str) -> bytes:
        """A word after a space, which is the first character of its first piece."""
        stem = word.rstrip(",.")
        if stem.isascii() and stem.isalpha():  # the commonest of what the pattern splits, known beforehand
            if stem == word:
                return self.piece_ids(" " + word)
            return self.words[stem] + self.pieces[word[len(stem) :]]
        return b"".join([self.pieces[p] for p in self.pattern.findall(" " + word)])

    def split(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, a window at a time."""
        lo, window = 0, WINDOW
        while lo < len(text):
            found = self.pattern.findall(text, lo, lo + window)
            if lo + window < len(text):
                # What ends near the window's end could be otherwise with the text behind it.
                seen = 0
                while found and seen <= AHEAD:
                    seen += len(found.pop())
                if not found:
                    window *= 2
                    continue
                lo += window - seen
                window = WINDOW
            else:
                lo = len(text)
            yield found

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        ids = []
        lo = 0
        while lo < len(text):
            cut = _WORD.search(text, lo + WINDOW) if len(text) - lo > WINDOW else None
            hi = cut.start() if cut else len(text)
            first, *words = _WORD.split(text[lo:hi])
            if len(first) > 1000:
                ids += [self.pieces[p] for part in self.split(first) for p in part]
            elif first:
                ids += map(self.pieces.__getitem__, self.pattern.findall(first))
            done = 0
            longest = max(map(len, words), default=0)
            for k in (k for k, word in enumerate(words) if len(word) > 1000) if longest > 1000 else ():
                ids += map(self.words.__getitem__, words[done:k])
                ids += [self.pieces[p] for part in self.split(" " + words[k]) for p in part]
                done = k + 1
            ids += map(self.words.__getitem__, words[done:])
            lo = hi
        return b"".join(ids)

    def decode(self, ids) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


class Encoded:
    """An encoded text that can be edited; only the pieces near an edit are encoded again."""

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary = vocabulary
        self.text = ""
        self.starts: list[int] = []
        self.last: list[list[int]] = []  # per piece, the last tokens of its prefixes
        self.replace(0, 0, text)

    def ids(self) -> list[int]:
        found = []
        for k, last in enumerate(self.last):
            start = self.starts[k]
            end = self.starts[k + 1] if k + 1 < len(self.starts) else len(self.text)
            whole = self.vocabulary.ranks.get(self.text[start:end].encode())
            found += self.vocabulary.read_back(last) if whole is None else [whole]
        return found

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, text: str) -> int:
        """Put `text` in place of the characters from `start` to `end`.

        Returns how many prefixes were worked out anew.
        """
        if not 0 <= start <= end <= len(self.text):
            raise IndexError(f"no characters {start} to {end} in a text of {len(self.text)}")
        old, self.text = self.text, self.text[:start] + text + self.text[end:]
        moved = len(text) - (end - start)
        # Pieces stay that end so far before the edit that it was not looked at; piece k ends where k + 1 begins.
        first = max(bisect_left(self.starts, start - AHEAD + 1) - 1, 0)
        position = self.starts[first] if self.starts else 0
        rest = bisect_left(self.starts, end)
        starts, lasts, worked = [], [], 0
        while position < len(self.text):
            while rest < len(self.starts) and self.starts[rest] + moved < position:
                rest += 1
            if (
                position >= start + len(text)
                and rest < len(self.starts)
                and self.starts[rest] + moved == position
            ):
                break
            found = self.vocabulary.pattern.match(self.text, position)
            piece = found.group().encode()
            known: list[int] = []
            same = bisect_left(self.starts, position)
            if same < len(self.starts) and self.starts[same] == position <= start:
                # The old piece at this place: what it shares with the new one is known.
                stop = self.starts[same + 1] if same + 1 < len(self.starts) else len(old)
                before = old[position:min(stop, max(start, position))].encode()
                shared = min(len(before), len(piece))
                known = self.last[same][:shared]
            worked += len(piece) - len(known)
            starts.append(position)
            lasts.append(self.vocabulary.extend(known, piece))
            position = found.end()
        else:
            rest = len(self.starts)
        self.starts = self.starts[:first] + starts + [s + moved for s in self.starts[rest:]]
        self.last = self.last[:first] + lasts + self.last[rest:]
        return worked


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """`doc_id` and `ids` of every whole text, without special tokens."""
    path = ranks_path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)

        def rows(names: list, ids: list[bytes]) -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, ids)]) // 4
            flat = np.frombuffer(b"".join(ids), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), lists], ["doc_id", "ids"])

        for batch in batches:
            names, ids, size = [], [], 0
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                names.append(name)
                ids.append(words.encode(text))
                size += len(text)
                if size >= BATCH:
                    yield rows(names, ids)
                    names, ids, size = [], [], 0
            if names:
                yield rows(names, ids)

    chosen = pick(docs, doc_id=id_col, text=text_col)
    return chosen.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(
        run, "doc_id bigint, ids array<int>"
    )


def decode(
    encoded: DataFrame,
    ids_col: str = "ids",
    bytes_col: str = "decoded",
    ranks_path: str | None = None,
    together: int = DECODED,
) -> DataFrame:
    """`encoded` with the bytes of its ids added."""
    path = ranks_path or public_tokenizers.path(RANKS)
    schema = f"{encoded.select('*').schema.simpleString()[7:-1]}, {bytes_col}: binary"
    position = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(vocabulary(path, public_tokenizers.PATTERN).tokens, pa.binary())
        for batch in batches:
            lo = 0
            column = batch.column(position)
            column = column.cast(pa.list_(pa.int32())).fill_null([]) if column.null_count else column
            ends = column.offsets.to_numpy()
            while lo < batch.num_rows:
                hi = int(np.searchsorted(ends, ends[lo] + together, "right")) - 1
                hi = min(max(hi, lo + 1), batch.num_rows)
                flat = column.values.slice(ends[lo], ends[hi] - ends[lo])
                joined = tokens.take(flat)
                if joined.null_count:
                    raise ValueError("an id is not in the vocabulary")
                _, offsets, data = joined.buffers()
                bounds = np.frombuffer(offsets, np.int32)[joined.offset :][ends[lo : hi + 1] - ends[lo]]
                decoded = pa.Array.from_buffers(
                    pa.binary(), hi - lo, [None, pa.py_buffer(np.ascontiguousarray(bounds)), data]
                )
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, decoded], names=[*part.schema.names, bytes_col]
                )
                lo = hi

    return encoded.mapInArrow(run, schema)
