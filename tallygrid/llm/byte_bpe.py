"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For a byte string under BPE every prefix has one encoding, so it has one last
token. ``PrefixTable`` stores that token per prefix: the last token of the prefix
of length i is the only vocabulary token t that ends at i and may follow the last
token of the prefix in front of it. Two tokens may stand side by side when no
merge joins bytes across their border before each of them is complete. Following
the stored tokens back from the end gives the encoding, in time linear in the
length. Appending bytes only extends the table; after an edit the rows before the
edit stay, and later rows are recomputed until they agree with the old ones over
a whole maximal token length, from where the rest is taken over.

Null text counts as empty and gives no ids. Every row of the input gives one row;
repeated rows are kept. Extra input columns do not matter: only the id and the
text column are read.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .textkit import slices

#: Pieces in each of the two generations of a worker's memory; what is forgotten is only computed again.
MEMORY_PIECES = 300_000
#: Longer pieces are not remembered.
LONGEST_SHARED = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (base64 and rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Tokens of a byte-level BPE, with the parts each was merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks), default=0)
        self._parts: dict[int, tuple[int, int] | None] = {}
        self.follows: dict[int, bool] = {}
        self._right: dict[int, list[int]] = {}
        self._left: dict[int, list[int]] = {}
        #: Tokens that merging can reach; only these can be a last token.
        self.reachable = {token: rank for token, rank in ranks.items() if self.reached(rank)}

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte; (-1, -1) if merging never gets there."""
        if token not in self._parts:
            self._parts[token] = self._find_parts(token)
        return self._parts[token]

    def _find_parts(self, token: int) -> tuple[int, int] | None:
        data = self.tokens[token]
        if len(data) == 1:
            return None
        pieces = [data[i:i + 1] for i in range(len(data))]
        never = len(self.tokens)
        while len(pieces) > 2:
            pairs = [self.ranks.get(a + b, never) for a, b in zip(pieces, pieces[1:])]
            best = min(range(len(pairs)), key=pairs.__getitem__)
            if pairs[best] in (never, token):
                return -1, -1
            pieces[best:best + 2] = [pieces[best] + pieces[best + 1]]
        if any(p not in self.ranks for p in pieces):
            return -1, -1
        left, right = self.ranks[pieces[0]], self.ranks[pieces[1]]
        return (left, right) if self.reached(left) and self.reached(right) else (-1, -1)

    def reached(self, token: int) -> bool:
        return self.parts(token) != (-1, -1)

    def _spine(self, token: int, side: int, memo: dict[int, list[int]]) -> list[int]:
        """Tokens at one edge of ``token`` while it is built, from the outermost byte up."""
        if token not in memo:
            chain, at = [token], token
            while parts := self.parts(at):
                at = parts[side]
                chain.append(at)
            memo[token] = chain[::-1]
        return memo[token]

    def may_follow(self, first: int, second: int) -> bool:
        """True if BPE of both tokens' bytes together is just these two tokens."""
        if len(self.follows) > 4 * MEMORY_PIECES:
            self.follows.clear()
        known = self.follows[first << 32 | second] = self._stays_apart(first, second)
        return known

    def _stays_apart(self, first: int, second: int) -> bool:
        a, b = self._spine(first, 1, self._right), self._spine(second, 0, self._left)
        never = len(self.tokens) + 1
        i = j = 0
        while True:
            next_a = a[i + 1] if i + 1 < len(a) else never
            next_b = b[j + 1] if j + 1 < len(b) else never
            across = self.ranks.get(self.tokens[a[i]] + self.tokens[b[j]], never)
            # of equal merges the leftmost comes first
            if across < next_a and across <= next_b and across < never:
                return False
            if next_a == never and next_b == never:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1


class PrefixTable:
    """Last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the string; stored rows stay exact."""
        self.data += more
        v, data, last = self.vocabulary, self.data, self.last
        known, follows, longest = v.reachable.get, v.follows.get, v.longest
        for end in range(len(last), len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = known(data[start:end])
                if token is None:
                    continue
                if start:
                    fits = follows(last[start] << 32 | token)
                    if fits is None:
                        fits = v.may_follow(last[start], token)
                    if not fits:
                        continue
                last.append(token)
                break
            else:
                raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes [start, end); returns the number of rows computed anew."""
        old_last, tail = self.last, self.data[end:]
        shift = start + len(new) - end
        self.data, self.last = self.data[:start], self.last[:start + 1]
        self.append(new)
        same, done = 0, len(new)
        for i in range(len(tail)):
            self.append(tail[i:i + 1])
            done += 1
            at = len(self.data)
            same = same + 1 if self.last[at] == old_last[at - shift] else 0
            if same >= self.vocabulary.longest:
                self.data += tail[i + 1:]
                self.last += old_last[at - shift + 1:]
                break
        return done

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.tokens[self.last[at]])
        return out[::-1]


class Encoder(dict):
    """Piece of text -> its ids as little-endian 32-bit bytes, remembered up to a bound.

    Pieces share prefixes, so the prefix table is shared as well: ``prefixes`` keeps
    the ids of byte prefixes (the last four bytes are the last token), and a new
    piece only adds rows behind its longest known prefix.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.prefixes: dict[bytes, bytes] = {}
        self.vocabulary = Vocabulary(ranks)
        self.find = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        short = len(piece) <= LONGEST_SHARED
        if out is None:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            if whole is not None:
                out = array("I", (whole,)).tobytes()
            elif short:
                out = self._extend(data)
            else:
                out = array("I", PrefixTable(self.vocabulary, data).ids()).tobytes()
        if short:
            if len(self) >= MEMORY_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = out
        return out

    def _extend(self, data: bytes) -> bytes:
        if len(self.prefixes) > 2 * MEMORY_PIECES:
            self.prefixes.clear()
        v, prefixes = self.vocabulary, self.prefixes
        known, follows, longest, get = v.reachable.get, v.follows.get, v.longest, prefixes.get
        end = len(data)
        while end and data[:end] not in prefixes:
            end -= 1
        before = [get(data[:i]) for i in range(max(0, end - longest), end + 1)]
        rows = [None] * max(0, end - longest) + before
        rows[0] = b""
        for end in range(end + 1, len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = known(data[start:end])
                if token is None:
                    continue
                head = rows[start]
                if start:
                    last = int.from_bytes(head[-4:], "little")
                    fits = follows(last << 32 | token)
                    if fits is None:
                        fits = v.may_follow(last, token)
                    if not fits:
                        continue
                row = head + token.to_bytes(4, "little")
                rows.append(row)
                prefixes[data[:end]] = row
                break
            else:
                raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")
        return rows[-1]

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text or "")))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, array("I", ids)))


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python worker; it outlives the task, and so does its memory."""
    key = (path, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(read_ranks(path), pattern)
    return _encoders[key]


def encode(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text",
           keep_ids: bool = True) -> DataFrame:
    """Ids of every text: (doc_id, n_tokens, ids, ids_sha256, decoded_sha256).

    ``path`` names the vocabulary file, which every executor has with its tokenizer
    package. ``keep_ids=False`` leaves the ids themselves out and keeps the digests.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for part in slices(batches):
            n, ids_sha, back_sha, blobs = [], [], [], []
            for value in part.column(1).to_pylist():
                ids = coder.encode(value)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                back_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if keep_ids:
                    blobs.append(ids)
            columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                       pa.array(back_sha, pa.string())] + [pa.array(blobs, pa.binary())] * keep_ids
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for part in slices(batches, "ids"):
            texts = [coder.decode(ids or b"").decode("utf-8", "replace") for ids in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
