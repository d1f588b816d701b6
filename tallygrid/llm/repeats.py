"""Removal of repeated byte strings: sampled suffixes are sorted first, all others are induced from them.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else in the corpus, the same document included. Sorting every suffix would need one
tuple a byte. As in induced sorting, a sparse sample of suffixes is sorted, and the
rest follows from it:

* Sample. Each string of ``length`` bytes has a representative: its ``gram``-byte
  substring of smallest hash, the leftmost of equals. The suffixes that start at a
  representative are the sample, about one of 70. Equal strings have equal
  representatives at equal places, so a string can only be repeated if its sampled
  suffix shares its first ``gram`` bytes with another sampled one.
* Sort. Sampled suffixes travel as tuples (name of the first ``gram`` bytes, name of
  the whole stretch whose strings they represent) to buckets of names, where Spark's
  shuffle sorts them on disk. Equal stretches elsewhere mean that all of the
  stretch's strings are repeated.
* Induce. Where suffixes agree in their first bytes but stretches differ (at the
  borders of repeats), the strings of these stretches, with one representative of
  each repeated stretch, are named and compared in a second exchange.

Names are 64-bit hashes of the bytes. All stages are exchanges between chunks of
documents and buckets of names (module ``chunks``): nothing is gathered by group, and a
passage that a third of the documents share costs one entry per chunk and bucket.

Rows: every input row gives one row, repeated rows too (they are copies of each other,
so their long strings go). Null text counts as empty. Texts shorter than ``length``
bytes keep everything. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import chunks as ch
from .textkit import Bytes, slices, span_hash

LENGTH = 200
GRAM = 64
_LOW = np.uint64(0xFFFFFFFF)
FULL, ASK = 1, 2
#: Text named at once; every byte takes some 80 bytes meanwhile.
SLICE_BYTES = 1 << 19


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima from both ends of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


class Stretches:
    """Sampled suffixes of one slice: the first and last string each represents, and two names."""

    def __init__(self, text: Bytes, length: int, gram: int):
        self.prefix = text.prefix()
        n = len(text.data)
        self.first = self.last = np.zeros(0, np.int64)
        self.name = self.whole = np.zeros(0, np.uint64)
        if n < length:
            return
        at = np.arange(n - gram + 1)
        names = span_hash(self.prefix, at, at + gram)
        chosen = sliding_minimum((names & ~_LOW) | at.astype(np.uint64), length - gram + 1)
        starts = np.flatnonzero(np.arange(length, n + 1) <= np.repeat(text.offsets[1:], np.diff(text.offsets))[:n - length + 1])
        if not len(starts):
            return
        place = (chosen[starts] & _LOW).astype(np.int64)
        cut = np.flatnonzero(np.diff(place)) + 1
        self.first = starts[np.concatenate([[0], cut])]
        self.last = starts[np.concatenate([cut - 1, [len(starts) - 1]])]
        self.name = names[place[np.concatenate([[0], cut])]]
        self.whole = span_hash(self.prefix, self.first, self.last + length)


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the first of each distinct key, in sorted order; how often it occurs; each entry's place among them."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    for key in keys:
        k = key[order]
        if key is keys[0]:
            new[1:] = False
        new[1:] |= k[1:] != k[:-1]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    return order[begin], np.diff(np.append(begin, len(order))), place


def _judge_stretches(columns: list[np.ndarray], chunk: np.ndarray) -> list[np.ndarray]:
    """Per named stretch: FULL if it occurs elsewhere; ASK if its strings must be compared one by one."""
    name, whole, several = columns
    first, count, place = _distinct(name, whole)
    repeated = np.zeros(len(first), bool)
    np.logical_or.at(repeated, place, several > 0)
    repeated |= count > 1
    names = name[first]
    begin = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(names))))
    mixed = (np.bincount(group, minlength=len(begin)) > 1) & (np.bincount(group, ~repeated, minlength=len(begin)) > 0)
    out = np.where(repeated[place], FULL, 0).astype(np.uint8)
    # of each stretch in a mixed group the first entry speaks, a single one for itself
    speaks = np.zeros(len(name), bool)
    speaks[first] = mixed[group]
    return [out | np.where(speaks, ASK, 0).astype(np.uint8)]


def _judge_strings(columns: list[np.ndarray], chunk: np.ndarray) -> list[np.ndarray]:
    """Per named string: 1 if it occurs more than once."""
    name, several = columns
    first, count, place = _distinct(name)
    repeated = count > 1
    np.logical_or.at(repeated, place, several > 0)
    return [repeated[place].astype(np.uint8)]


def _chunk(table: pa.Table, length: int, gram: int) -> tuple[list[pa.RecordBatch], list[Stretches]]:
    parts = list(slices(ch.parts_of(table), limit=SLICE_BYTES))
    found = []
    for part in parts:
        s = Stretches(Bytes(part.column(1)), length, gram)
        s.prefix = None
        found.append(s)
    return parts, found


def _keys(found: list[Stretches]) -> tuple[np.ndarray, np.ndarray, tuple]:
    name, whole = (np.concatenate([getattr(s, k) for s in found]) for k in ("name", "whole"))
    return name, whole, _distinct(name, whole)


def _strings(parts: list[pa.RecordBatch], found: list[Stretches], picked: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Names of the strings in the picked stretches and their first bytes, slice by slice, and how many each slice has."""
    names, places, many = [], [], []
    done = 0
    for part, s in zip(parts, found):
        own = picked[done:done + len(s.first)]
        done += len(s.first)
        if own.any():
            first, n = s.first[own], s.last[own] - s.first[own] + 1
            at = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            names.append(span_hash(Bytes(part.column(1)).prefix(), at, at + length))
            places.append(at.astype(np.uint32))
        many.append(n.sum() if own.any() else 0)
    join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return join(names, np.uint64), join(places, np.uint32), np.array(many, np.int64)


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text",
                   keep_bytes: bool = True, chunk_bytes: int = ch.CHUNK_BYTES, bucket_bytes: int = ch.BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row; ``kept`` only with ``keep_bytes``."""
    rows, buckets = ch.dealt(docs, doc_id=doc_id, text=text, chunk_bytes=chunk_bytes, bucket_bytes=bucket_bytes)

    def ask_stretches(table: pa.Table, chunk: int, _: list) -> pa.Table:
        _, found = _chunk(table, length, gram)
        name, whole, (first, count, _) = _keys(found)
        return ch.blocks(chunk, 0, name[first], [whole[first], (count > 1).astype(np.uint8)], buckets)

    def picked_strings(found: list[Stretches], verdict: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marks of repeated stretches, and of the stretches (one of equals) whose strings are compared."""
        _, _, (first, _, place) = _keys(found)
        verdict = verdict if len(verdict) else np.zeros(len(first), np.uint8)
        once = np.zeros(len(place), bool)
        once[first] = True
        return (verdict & FULL > 0)[place], once & (verdict & ASK > 0)[place]

    def ask_strings(table: pa.Table, chunk: int, answers: list) -> pa.Table:
        parts, found = _chunk(table, length, gram)
        _, picked = picked_strings(found, answers[0][0] if answers else np.zeros(0, np.uint8))
        names, _, _ = _strings(parts, found, picked, length)
        first, count, _ = _distinct(names)
        return ch.blocks(chunk, 1, names[first], [(count > 1).astype(np.uint8)], buckets)

    def finish(table: pa.Table, chunk: int, answers: list) -> pa.Table:
        parts, found = _chunk(table, length, gram)
        full, picked = picked_strings(found, answers[0][0] if answers else np.zeros(0, np.uint8))
        names, places, many = _strings(parts, found, picked, length)
        again = answers[1][0][_distinct(names)[2]] > 0 if len(answers) > 1 and answers[1] else np.zeros(len(names), bool)
        del names
        out, done, told = [], 0, 0
        for part, s, n in zip(parts, found, many):
            body = Bytes(part.column(1))
            own = full[done:done + len(s.first)]
            done += len(s.first)
            edge = np.zeros(len(body.data) + 1, np.int32)
            np.add.at(edge, s.first[own], 1)
            np.add.at(edge, s.last[own] + length, -1)
            mine = places[told:told + n][again[told:told + n]].astype(np.int64)
            told += n
            np.add.at(edge, mine, 1)
            np.add.at(edge, mine + length, -1)
            out.append(_result(part, body, np.cumsum(edge[:-1]) > 0, keep_bytes))
        return pa.Table.from_batches(out)

    stretches = ch.answer(ch.ask(rows, ask_stretches), buckets, _judge_stretches)
    strings = ch.answer(ch.ask(rows, ask_strings, stretches), buckets, _judge_strings)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * keep_bytes
    return ch.ask(rows, finish, stretches.unionByName(strings), schema)


def _result(part: pa.RecordBatch, body: Bytes, gone: np.ndarray, keep_bytes: bool) -> pa.RecordBatch:
    at = body.offsets
    inside = np.concatenate([[False], gone])
    begins = gone & (~inside[:-1] | body.starts_document()[:-1])
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[at]).astype(np.int64)
    kept = [body.data[a:b][~gone[a:b]].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    columns = [part.column(0), pa.array(np.diff(at)), pa.array(sums(gone)), pa.array(sums(begins)),
               pa.array([hashlib.sha256(k).hexdigest() for k in kept])] + [pa.array(kept, pa.binary())] * keep_bytes
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes)
