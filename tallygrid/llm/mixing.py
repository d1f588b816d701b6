"""Language-model scores by logistic context mixing, learned from the corpus's words.

A text (A-Z lower-cased) is a sequence of units: a word, and the white-space byte or
the end of text that stops it. A unit is spelled by binary decisions: each byte, or the
stop, is a path in a Huffman tree of the corpus's bytes, and then the stop's kind has
three bits. Each decision has several bit predictors. Predictor k keeps the counts of
zeros and ones seen after the hash of the last k bytes of the word and the node; its
vote is the log-odds of those counts. A gate (which predictors have seen the context,
and how deep the node is) selects a weight set that mixes the votes; the mixed
probability is refined by an adaptive table (node x quantised log-odds -> observed rate).

Hash tables of a fixed size cannot hold all words of a large corpus, so whole units
have an exact table that grows with it. It is combined with the spelling by absolute
discounting: P(unit) = max(c - d, 0) / N + d * T / N * P(spelling), where c is the
unit's training count, N and T the numbers of all and of distinct training units, and
d follows from the units seen once and twice. Both parts are proper, hence so is their
sum. This much does not depend on other units, so every distinct unit is priced once,
however often it occurs.

Across words, the two units before give a third prediction: the counts of what followed
them in the corpus, by class (16 bits of the following unit's hash, which keep the keys
short), times the unit's share of the training counts of its class. Shares of a class add
up to 1, so those of a context do too, however many units follow it. Its weight is gated by how many predictions in a row
have come true and by how often the context was seen, and adapts within the text: it is
the share of right predictions at that gate so far, from a fixed prior. It uses only
what stands before, so the mixture stays a probability. In a training text its own
occurrences do not count here.

Learning, over all training texts:

1. Every task names its distinct words and their counts by stop; buckets of words add
   these up. This table grows with the corpus, and so does all that follows from it.
2. Counts of the predictors: every word feeds its contexts, weighted by its count. The
   tables have ``2 ** bits`` places for each predictor, whatever the corpus.
3. Mixing weights: every task steps through its words in small batches, updating the
   selected weight sets online; the tasks' weights are averaged by the text they saw.
4. Refinement table: observed bits by node and quantised mixed log-odds.

In 3 and 4 a word's own occurrence is taken out of the counts first.

Scoring exchanges keys with buckets (module ``chunks``): a chunk names its distinct words
and its distinct pairs of context and unit, and gets each word's training count and
its units' costs, and each pair's and context's training count.

Rows: every input row gives one row, repeated rows too. Null counts as empty: one end.
Without training text every decision has probability 1/2 and the base has V = N = 0.
Only the id and text columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import settle
from . import chunks as ch
from .textkit import IS_SPACE, SPACES, Bytes, byte_planes, distinct, from_byte_planes, from_planes, mix, pack, planes, slices, span_hash, unpack

#: Bytes of context and table bits of each predictor.
ORDERS = (1, 2, 3, 4, 6)
BITS = (18, 19, 20, 20, 20)
#: Stops: the six white-space bytes, then the end of the text.
STOPS = len(SPACES) + 1
END = STOPS - 1
_STOP_OF = np.zeros(256, np.uint8)
_STOP_OF[list(SPACES)] = np.arange(len(SPACES))

#: Nodes: 0-255 the inner nodes of the Huffman tree over bytes and the stop; 257-263 the bits of a stop's kind.
STOP_SYMBOL = 256
NODES = 264
#: Gates see depths up to this one, and the kind bits apart.
KINDS = 10
GATES = KINDS * (len(ORDERS) + 1)
STEPS = 33
WORDS_AT_ONCE = 4000
MERGE_SLICES = 16
#: Hash bits of a following unit in the key of a context.
CLASS_BITS = 16
PRIOR = np.float32(0.4)


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Packed arrays, compressed: byte planes of small numbers take little more than their entropy."""
    return zstandard.ZstdCompressor(level=1).compress(pack(*arrays))


def _open(blob: bytes) -> list[np.ndarray]:
    return unpack(zstandard.ZstdDecompressor().decompress(blob))


@dataclass
class Words:
    """Distinct words sorted by hash: counts by stop, and the bytes end to end."""

    name: np.ndarray
    counts: np.ndarray
    sizes: np.ndarray
    data: np.ndarray

    @staticmethod
    def empty() -> Words:
        return Words(np.zeros(0, np.uint64), np.zeros((0, STOPS), np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8))

    def take(self, index: np.ndarray) -> Words:
        starts = np.cumsum(self.sizes) - self.sizes
        return Words(self.name[index], self.counts[index], self.sizes[index], _gather(self.data, starts[index], self.sizes[index]))

    def packed(self) -> bytes:
        cell = np.flatnonzero(self.counts)
        return _squeeze(planes(self.name), planes(cell.astype(np.uint64)), byte_planes(self.counts.ravel()[cell]),
                        byte_planes(self.sizes.astype(np.uint32)), self.data)

    @staticmethod
    def unpacked(blob: bytes) -> Words:
        name, cell, seen, sizes, data = _open(blob)
        name = from_planes(name)
        counts = np.zeros(len(name) * STOPS, np.int64)
        counts[from_planes(cell).astype(np.int64)] = from_byte_planes(seen, np.int64)
        return Words(name, counts.reshape(-1, STOPS), from_byte_planes(sizes, np.uint32).astype(np.int64), data)

    @staticmethod
    def merged(parts: list[Words]) -> Words:
        parts = [p for p in parts if len(p.name)]
        if len(parts) < 2:
            return parts[0] if parts else Words.empty()
        joined = Words(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("name", "counts", "sizes", "data")))
        order = np.argsort(joined.name, kind="stable")
        names = joined.name[order]
        begin = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        out = joined.take(order[begin])
        out.counts = np.add.reduceat(joined.counts[order], begin, axis=0)
        return out


def unit_hash(names: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return mix(names + stop.astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))


def unit_classes(names: np.ndarray) -> np.ndarray:
    """Class of each word's units, by stop."""
    return (unit_hash(names[:, None], np.arange(STOPS)[None, :]) >> np.uint64(64 - CLASS_BITS)).astype(np.int64)


def class_counts(words: Words) -> np.ndarray:
    """Training occurrences of each class of units."""
    return np.bincount(unit_classes(words.name).ravel(), words.counts.ravel(), 1 << CLASS_BITS)


def class_shares(words: Words, totals: np.ndarray) -> np.ndarray:
    """Share of each word's units, by stop, in the training occurrences of their class."""
    return words.counts / np.maximum(totals[unit_classes(words.name)], 1)


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    if not len(sizes):
        return np.zeros(0, np.uint8)
    return data[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


class Units:
    """Units of one slice: word start, size, stop, document, and distinct words."""

    def __init__(self, texts: pa.Array):
        body = Bytes(texts, lower=True)
        self.docs = body.docs
        spaces = np.flatnonzero(IS_SPACE[body.data])
        # a text's end comes before a white-space byte of the next text at the same place
        keys = np.sort(np.concatenate([2 * spaces + 1, 2 * body.offsets[1:]]), kind="stable")
        ends, space = keys >> 1, (keys & 1).astype(bool)
        starts = np.concatenate([[0], (ends + space)[:-1]]) if len(ends) else ends
        self.stop = np.where(space, _STOP_OF[body.data[np.minimum(ends, len(body.data) - 1)]] if len(body.data) else 0, END)
        self.doc = np.cumsum(~space) - ~space
        self.starts, self.sizes, self.data = starts, ends - starts, body.data
        names = span_hash(body.prefix(), starts, ends)
        self.word_names = names
        self.names, self.place = np.unique(names, return_inverse=True)
        # some occurrence of each word
        self.first = np.empty(len(self.names), np.int64)
        self.first[self.place] = np.arange(len(names))

    def pairs(self, bits: int) -> np.ndarray:
        """Keys of (two units before, class of the unit): leading bits of the context's hash, then those of the class."""
        unit = unit_hash(self.word_names, self.stop)
        begins = np.concatenate([[True], self.doc[1:] != self.doc[:-1]]) if len(unit) else np.zeros(0, bool)
        one = np.where(begins, np.uint64(1), np.concatenate([unit[:1], unit[:-1]]))
        two = np.where(begins, np.uint64(2), np.concatenate([one[:1], one[:-1]]))
        context = mix(one * np.uint64(0x9E3779B97F4A7C15) + two)
        return (context >> np.uint64(64 - bits)) << np.uint64(CLASS_BITS) | unit >> np.uint64(64 - CLASS_BITS)

    def words(self, learn: np.ndarray) -> Words:
        """Distinct words with their counts in the documents marked in ``learn``."""
        counts = np.bincount(self.place * STOPS + self.stop, weights=learn[self.doc], minlength=STOPS * len(self.names))
        sizes = self.sizes[self.first]
        return Words(self.names, counts.reshape(-1, STOPS).astype(np.int64), sizes, _gather(self.data, self.starts[self.first], sizes))


#: Counts are kept in one byte: exact up to 31, then in steps of 8 %.
_EXACT = 32
_VALUE = np.concatenate([np.arange(_EXACT), _EXACT * 1.08 ** np.arange(256 - _EXACT)]).astype(np.float32)
_LOG = np.log(_VALUE + PRIOR)


def in_bytes(counts: np.ndarray) -> np.ndarray:
    """Nearest stored value of each count."""
    return np.searchsorted((_VALUE[1:] + _VALUE[:-1]) / 2, counts).astype(np.uint8)


class Tree:
    """Huffman paths of the 256 bytes and the stop: node and bit by symbol and depth."""

    def __init__(self, counts: np.ndarray):
        heap = [(float(c) + 1, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        children, parents = {}, len(counts)
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            children[parents] = (x, y)
            heapq.heappush(heap, (a + b, parents))
            parents += 1
        paths: dict[int, list[tuple[int, int]]] = {heap[0][1]: []}
        for inner in range(parents - 1, len(counts) - 1, -1):
            for bit in (0, 1):
                paths[children[inner][bit]] = paths[inner] + [(inner - len(counts), bit)]
        self.length = np.array([len(paths[i]) for i in range(len(counts))])
        self.node, self.bit = np.zeros((2, len(counts), self.length.max()), np.int64)
        for i in range(len(counts)):
            for depth, (node, bit) in enumerate(paths[i]):
                self.node[i, depth], self.bit[i, depth] = node, bit


def symbol_counts(words: Words) -> np.ndarray:
    seen = words.counts.sum(axis=1)
    return np.append(np.bincount(words.data, np.repeat(seen, words.sizes), 256), seen.sum())


class Decisions:
    """The binary decisions of some words, depth by depth: (contexts, node, gate kind, bit, weight, word, stop or None)."""

    def __init__(self, words: Words, used: np.ndarray, tree: Tree):
        self.tree, self.used = tree, used
        length = words.sizes + 1
        word = np.repeat(np.arange(len(length)), length)
        inside = np.arange(len(word)) - np.repeat(np.cumsum(length) - length, length)
        at = np.repeat(np.cumsum(words.sizes) - words.sizes, length) + inside
        data = np.append(words.data, np.uint8(0)).astype(np.uint64)
        context, h, reach = [], np.zeros(len(word), np.uint64), 0
        for order in ORDERS:
            while reach < order:
                reach += 1
                byte = np.where(inside >= reach, data[np.maximum(at - reach, 0)] + np.uint64(2), np.uint64(1))
                h = h * np.uint64(0x2545F4914F6CDD1D) + byte
            context.append(mix(h + np.uint64(order)))
        self.context, self.word = context, word
        self.last = inside == words.sizes[word]
        self.symbol = np.where(self.last, STOP_SYMBOL, data[np.minimum(at, len(data) - 1)].astype(np.int64))
        self.weight = words.counts.sum(axis=1)[word].astype(np.float64)
        self.stop_counts = words.counts.astype(np.float64)

    def __iter__(self) -> Iterator[tuple]:
        tree, depth, on = self.tree, 0, np.arange(len(self.word))
        while len(on):
            symbol = self.symbol[on]
            kind = np.full(len(on), min(depth, KINDS - 2))
            yield ([c[on] for c in self.context], tree.node[symbol, depth], kind, tree.bit[symbol, depth],
                   self.weight[on], self.word[on], None)
            depth += 1
            on = on[tree.length[symbol] > depth]
        word, stop = np.nonzero(self.used)
        end = np.flatnonzero(self.last)[word]
        context, weight, node = [c[end] for c in self.context], self.stop_counts[word, stop], np.ones(len(word), np.int64)
        for shift in (2, 1, 0):
            bit = stop >> shift & 1
            yield context, node + 256, np.full(len(word), KINDS - 1), bit, weight, word, stop
            node = 2 * node + bit


def places(context: list[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    """Where each predictor keeps the zeros of a decision; its ones follow."""
    step = mix(node.astype(np.uint64) + np.uint64(77))
    return [(((c ^ step) * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - bits)).astype(np.int64) * 2
            for c, bits in zip(context, BITS)]


@dataclass
class Model:
    """Counts per predictor (one byte each, once learned), weights per gate, refinement table."""

    tables: list[np.ndarray]
    weights: np.ndarray
    refine: np.ndarray
    tree: Tree

    @staticmethod
    def blank(tree: Tree) -> Model:
        weights = np.full((GATES, len(ORDERS) + 1), 0.3)
        weights[:, -1] = 0
        return Model([np.zeros(2 << b, np.float32) for b in BITS], weights, np.zeros((NODES, STEPS, 2)), tree)

    def votes(self, context: list[np.ndarray], node: np.ndarray, kind: np.ndarray, bit: np.ndarray | None, seen: np.ndarray | None
              ) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each predictor, with a constant, and the gate; ``seen`` occurrences of ``bit`` are taken out."""
        x = np.ones((len(ORDERS) + 1, len(node)), np.float32)
        level = np.zeros(len(node), np.int64)
        for k, (table, at) in enumerate(zip(self.tables, places(context, node))):
            low, high = table[at], table[at + 1]
            if seen is None:
                x[k] = _LOG[high] - _LOG[low]
                level[(low > 1) | (high > 1) | (low + high > 1)] = k + 1
            else:
                zeros = np.maximum(_VALUE[low] - np.where(bit == 0, seen, 0), 0)
                ones = np.maximum(_VALUE[high] - np.where(bit == 1, seen, 0), 0)
                x[k] = np.log((ones + PRIOR) / (zeros + PRIOR))
                level[zeros + ones >= 2] = k + 1
        return x, kind * (len(ORDERS) + 1) + level

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("kn,kn->n", x, self.weights.T.astype(np.float32)[:, gate]), -15, 15).astype(np.float64)

    def refined(self, node: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Probability of a one: the mean of the mixed one and the interpolated observed one."""
        spot = np.clip((z + 12) * ((STEPS - 1) / 24), 0, STEPS - 1.000001)
        low = spot.astype(np.int64)
        part = spot - low
        centre = 1 / (1 + np.exp(-(np.arange(STEPS) * (24 / (STEPS - 1)) - 12)))
        rate = (self.refine[:, :, 1] + 4 * centre) / (self.refine.sum(axis=2) + 4)
        return ((1 - part) * rate[node, low] + part * rate[node, low + 1] + 1 / (1 + np.exp(-z))) / 2

    def learn_counts(self, words: Words) -> None:
        for batch in _batches(words):
            for context, node, kind, bit, weight, _, _ in Decisions(batch, batch.counts > 0, self.tree):
                for table, at in zip(self.tables, places(context, node)):
                    np.add.at(table, at + bit, weight.astype(np.float32))

    def learn_weights(self, words: Words, rate: float = 0.03) -> float:
        """Online steps over the words; returns the number of training units seen."""
        speed = np.full_like(self.weights, 1e-3)
        for batch in _batches(words):
            for context, node, kind, bit, weight, _, _ in Decisions(batch, batch.counts > 0, self.tree):
                x, gate = self.votes(context, node, kind, bit, np.minimum(weight, 1).astype(np.float32))
                error = (bit - 1 / (1 + np.exp(-self.mixed(x, gate)))) * weight
                mass = np.maximum(np.bincount(gate, weight, GATES), 1)
                for k in range(x.shape[0]):
                    step = np.bincount(gate, error * x[k], GATES) / mass
                    speed[:, k] += step * step
                    self.weights[:, k] += rate * step / np.sqrt(speed[:, k])
        return float(words.counts.sum())

    def learn_refinement(self, words: Words) -> None:
        for batch in _batches(words):
            for context, node, kind, bit, weight, _, _ in Decisions(batch, batch.counts > 0, self.tree):
                x, gate = self.votes(context, node, kind, bit, np.minimum(weight, 1).astype(np.float32))
                spot = np.clip((self.mixed(x, gate) + 12) * ((STEPS - 1) / 24), 0, STEPS - 1.000001)
                low, part = spot.astype(np.int64), spot - spot.astype(np.int64)
                flat = self.refine.reshape(-1)
                for cell, share in ((low, 1 - part), (low + 1, part)):
                    flat += np.bincount((node * STEPS + cell) * 2 + bit, weight * share, flat.size)

    def spelling(self, words: Words, used: np.ndarray) -> np.ndarray:
        """Bits of spelling each (word, stop) in ``used``; other cells are 0."""
        out = np.zeros((len(words.name), STOPS))
        done = 0
        for batch in _batches(words):
            n = len(batch.name)
            mine = used[done:done + n]
            word_cost, stop_cost = np.zeros(n), np.zeros((n, STOPS))
            for context, node, kind, bit, _, word, stop in Decisions(batch, mine, self.tree):
                x, gate = self.votes(context, node, kind, None, None)
                p = self.refined(node, self.mixed(x, gate))
                bits = -np.log2(np.where(bit == 1, p, 1 - p))
                if stop is None:
                    word_cost += np.bincount(word, bits, n)
                else:
                    stop_cost[word, stop] += bits
            out[done:done + n] = np.where(mine, word_cost[:, None] + stop_cost, 0)
            done += n
        return out


@dataclass
class Census:
    """Training units: all, distinct, seen once, seen twice."""

    units: int = 0
    distinct: int = 0
    once: int = 0
    twice: int = 0

    def bits(self, counts: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        """Bits of units with training counts and bits of spelling, by absolute discounting."""
        if not self.units:
            return spelling
        discount = min(0.95, max(0.05, self.once / max(1, self.once + 2 * self.twice)))
        share = np.maximum(counts - discount, 0) / self.units
        return -np.log2(share + discount * self.distinct / self.units * np.exp2(-spelling))


#: Gates of the context's prediction: right ones in a row so far, and sightings of the context.
RUNS, SIGHTS = 5, 3
#: Prior share of right predictions by run; it weighs as much as ``PRIOR_TRIES`` tries.
RUN_PRIOR = np.array([0.1, 0.4, 0.7, 0.9, 0.97])
PRIOR_TRIES = 4.0


def with_context(bits: np.ndarray, pair: np.ndarray, context: np.ndarray, begins: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Bits of units in text order, given the counts of their (context, class) pair and of their context.

    ``within`` is the unit's share of its class; a unit never seen in training has none.

    ``begins`` marks the first unit of each text; runs and gates start anew there.
    """
    n = len(bits)
    if not n:
        return bits
    right, tried = (pair > 0) & (within > 0), context > 0
    at = np.arange(n)
    # right predictions in a row just before each unit
    stop = np.maximum.accumulate(np.where(~right, at, -1))
    before = np.concatenate([[-1], stop[:-1]])
    first = np.maximum.accumulate(np.where(begins, at, 0))
    run = np.minimum(at - 1 - np.maximum(before, first - 1), RUNS - 1)
    gate = run * SIGHTS + np.minimum(context, SIGHTS).clip(1) - 1
    text = np.cumsum(begins) - 1
    cell = text * (RUNS * SIGHTS) + gate
    cell = np.where(tried, cell, -1)
    # short numbers sort faster
    order = np.argsort((cell + 1).astype(np.uint16) if cell.max() < 65_535 else cell, kind="stable")
    c, hit = cell[order], (right & tried)[order].astype(np.float64)
    sums = np.cumsum(hit) - hit
    start = np.concatenate([[True], c[1:] != c[:-1]])
    origin = np.maximum.accumulate(np.where(start, at, 0))
    tries, hits = at - origin, sums - sums[origin]
    weight = np.empty(n)
    weight[order] = (hits + PRIOR_TRIES * RUN_PRIOR[run[order]]) / (tries + PRIOR_TRIES)
    weight = np.where(tried, np.minimum(weight, 0.999), 0)
    share = np.where(tried, pair / np.maximum(context, 1) * within, 0)
    return -np.log2(weight * share + (1 - weight) * np.exp2(-bits))


def _batches(words: Words) -> Iterator[Words]:
    ends = np.cumsum(words.sizes)
    for a in range(0, len(words.name), WORDS_AT_ONCE):
        b = min(a + WORDS_AT_ONCE, len(words.name))
        start = ends[a] - words.sizes[a]
        yield Words(words.name[a:b], words.counts[a:b], words.sizes[a:b], words.data[start:ends[b - 1]])


def word_table(docs: DataFrame, learn: Column, buckets: int, *, doc_id: str, text: str) -> DataFrame:
    """All distinct words of the corpus by bucket: ``data``, training tokens ``n`` and distinct ones ``v``, and a census of units."""
    shape = "bucket int, data binary"

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Words] = []

        def flush() -> Iterator[pa.RecordBatch]:
            words = Words.merged(held)
            held.clear()
            at = ch.bucket_bounds(words.name, buckets)
            for b in np.flatnonzero(np.diff(at)).tolist():
                part = words.take(np.arange(at[b], at[b + 1]))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "data": pa.array([part.packed()], pa.binary())})

        for part in slices(batches):
            held.append(Units(part.column(1)).words(part.column(0).to_numpy(zero_copy_only=False).astype(float)))
            if len(held) == MERGE_SLICES:
                yield from flush()
        if held:
            yield from flush()

    def add(table: pa.Table) -> pa.Table:
        words = Words.merged([Words.unpacked(b.as_py()) for b in table.column("data")])
        seen = words.counts.sum(axis=1) * (words.sizes > 0)
        return pa.Table.from_pydict({"bucket": table.column("bucket").slice(0, 1), "n": pa.array([int(seen.sum())], pa.int64()),
                                     "v": pa.array([int((seen > 0).sum())], pa.int64()),
                                     **{f"u{k}": pa.array([int((words.counts == k).sum())], pa.int64()) for k in (1, 2)},
                                     "units": pa.array([int(words.counts.sum())], pa.int64()),
                                     "distinct": pa.array([int((words.counts > 0).sum())], pa.int64()), "data": pa.array([words.packed()], pa.binary())})

    named = docs.select(learn.alias("learn"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(name, shape)
    return named.groupBy("bucket").applyInArrow(add, "bucket int, n bigint, v bigint, u1 bigint, u2 bigint, units bigint, "
                                                "distinct bigint, data binary")


def _added(parts: DataFrame, kind: type = np.float64) -> list[np.ndarray]:
    """Sum of packed arrays by key (order, block), end to end by order; its size is fixed by parameters."""

    def numbers(blob: bytes) -> np.ndarray:
        return from_byte_planes(_open(blob)[0], kind)

    def add(table: pa.Table) -> pa.Table:
        total = None
        for blob in table.column("data"):
            part = numbers(blob.as_py())
            total = part if total is None else total + part
        return pa.Table.from_pydict({"k": table.column("k").slice(0, 1), "block": table.column("block").slice(0, 1),
                                     "data": pa.array([_squeeze(byte_planes(total))], pa.binary())})

    rows = parts.groupBy("k", "block").applyInArrow(add, "k int, block int, data binary").collect()
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["k"], r["block"])):
        out.setdefault(r["k"], []).append(numbers(r["data"]))
    return [np.concatenate(out[k]) for k in sorted(out)]


def _learned(part: pa.RecordBatch) -> np.ndarray:
    """1 for the slice's training texts, 0 for the others."""
    return part.column(part.schema.get_field_index("learn")).to_numpy(zero_copy_only=False).astype(float)


def _stops_used(units: list[Units]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct words of a chunk, and the stops each is followed by, as bits."""
    names = distinct(np.concatenate([u.names for u in units]))
    used = np.zeros(len(names), np.uint8)
    for u in units:
        np.bitwise_or.at(used, np.searchsorted(names, u.names)[u.place], (1 << u.stop).astype(np.uint8))
    return names, [used]


def _cells(stops: np.ndarray) -> np.ndarray:
    """Bits as a table of marks."""
    return (stops[:, None] >> np.arange(STOPS, dtype=np.uint8) & 1).astype(bool)


def plain_counts(stage: int, columns: list[np.ndarray]) -> list[np.ndarray]:
    """An answer's columns with its counts as numbers."""
    kinds = (np.uint32, None, np.int64) if stage == 0 else (np.uint32, np.uint32)
    return [from_byte_planes(c, kind).astype(np.int64) if kind else c for c, kind in zip(columns, kinds)]


def _blocks(chunk: int, stage: int, keys: np.ndarray, columns: list[np.ndarray], at: np.ndarray) -> pa.Table:
    """Blocks of a chunk's sorted keys and their columns, one per bucket that gets any; bucket b's keys begin at ``at[b]``."""
    used = np.flatnonzero(np.diff(at))
    data = [_squeeze(planes(keys[at[b]:at[b + 1]]), *[byte_planes(c[at[b]:at[b + 1]]) for c in columns]) for b in used]
    return pa.Table.from_pydict({"bucket": pa.array(used, pa.int32()), "chunk": pa.array([chunk] * len(used), pa.int32()),
                                 "stage": pa.array([stage] * len(used), pa.int32()), "data": pa.array(data, pa.binary())})


def _own_counts(pair: np.ndarray, context: np.ndarray, doc: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each unit's pair and context occur in its own text, as far as those were counted.

    ``pair`` and ``context`` are numbers that sort alike: pairs of one context stand together.
    """
    order = np.argsort(doc * (pair.max(initial=0) + 1) + pair)
    begins = np.diff(doc[order], prepend=-1) != 0
    out = []
    for key in (pair, context):
        start = np.flatnonzero(begins | (np.diff(key[order], prepend=-1) != 0))
        n = np.diff(np.append(start, len(order)))
        own = np.empty(len(order), np.int64)
        own[order] = np.repeat(n, n)
        out.append(np.where(learned > 0, own, 0))
    return out[0], out[1]


def fit(words: DataFrame, tasks: int) -> tuple[Model, np.ndarray]:
    """Model of a word table (predictor counts, then mixing weights, then refinement), and the training counts of unit classes."""
    spark = words.sparkSession
    few = words.select("data").coalesce(tasks)
    shape, block = "k int, block int, data binary", 1 << 18

    def pieces(arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, array in enumerate(arrays):
            for b in range(0, len(array), block):
                yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "block": pa.array([b // block], pa.int32()),
                                                  "data": pa.array([_squeeze(byte_planes(array[b:b + block]))], pa.binary())})

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
        for batch in batches:
            for blob in batch.column(0):
                words = Words.unpacked(blob.as_py())
                words = words.take(np.flatnonzero(words.counts.sum(axis=1) > 0))
                if len(words.name):
                    yield words

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, classes = np.zeros(257), np.zeros(1 << CLASS_BITS)
        for part in stored(batches):
            symbols += symbol_counts(part)
            classes += class_counts(part)
        yield from pieces([symbols, classes])

    symbols, classes = _added(words.select("data").mapInArrow(letters, shape)) or [np.zeros(257), np.zeros(1 << CLASS_BITS)]
    tree = Tree(symbols)
    model = Model.blank(tree)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, any_ = Model.blank(tree), False
        for part in stored(batches):
            own.learn_counts(part)
            any_ = True
        if any_:
            yield from pieces(own.tables)

    tables = _added(few.mapInArrow(count, shape), np.float32)
    if not tables:
        return model, classes
    model.tables = [in_bytes(t) for t in tables]
    shared = spark.sparkContext.broadcast(model.tables)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, mass = Model.blank(tree), 0.0
        own.tables = shared.value
        for part in stored(batches):
            mass += own.learn_weights(part)
        if mass:
            yield from pieces([np.append(own.weights.ravel() * mass, mass)])

    total = _added(words.select("data").mapInArrow(weigh, shape))[0]
    model.weights = (total[:-1] / total[-1]).reshape(model.weights.shape)
    weights = model.weights

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value, weights, np.zeros((NODES, STEPS, 2)), tree)
        for part in stored(batches):
            own.learn_refinement(part)
        if own.refine.any():
            yield from pieces([own.refine.ravel()])

    model.refine = _added(words.select("data").mapInArrow(refine, shape))[0].reshape(model.refine.shape)
    return model, classes


def score(docs: DataFrame, learn: Column, *, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = 2 * ch.CHUNK_BYTES,
          bucket_bytes: int = ch.BUCKET_BYTES // 2) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) for every row.

    ``learn`` (on the id column) marks the rows to learn from.
    """
    spark = docs.sparkSession
    rows, buckets = ch.dealt(docs.withColumn("learn", learn), doc_id=doc_id, text=text, chunk_bytes=chunk_bytes,
                             bucket_bytes=bucket_bytes, more=("learn",))
    bits = ch.key_bits(buckets)
    words = settle(word_table(docs, learn, buckets, doc_id=doc_id, text=text))
    held = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), *[F.sum(c).alias(c) for c in ("units", "distinct", "u1", "u2")]).first()
    census = Census(*[held[c] or 0 for c in ("units", "distinct", "u1", "u2")])
    texts = docs.where(learn).count()
    total, distinct = (held["n"] or 0) + texts, (held["v"] or 0) + (texts > 0)
    fitted, totals = map(spark.sparkContext.broadcast, fit(words, max(1, -(-buckets // 8))))

    def seen_pairs(parts: list[pa.RecordBatch]) -> tuple[list[Units], np.ndarray, np.ndarray]:
        """Units of a chunk's slices, its distinct pairs, and the place of each unit's pair among these."""
        units = [Units(p.column(1)) for p in parts]
        keys, place = np.unique(np.concatenate([u.pairs(bits) for u in units]), return_inverse=True)
        return units, keys, place

    def ask(table: pa.Table, chunk: int, _: list) -> pa.Table:
        parts = list(slices(ch.parts_of(table)))
        units, keys, place = seen_pairs(parts)
        learned = np.concatenate([_learned(p)[u.doc] for p, u in zip(parts, units)])
        count = np.bincount(place, learned, len(keys)).astype(np.uint32)
        names, stops = _stops_used(units)
        return pa.concat_tables([_blocks(chunk, 0, names, stops, ch.bucket_bounds(names, buckets)),
                                 _blocks(chunk, 1, keys, [count], ch.bucket_bounds(keys << np.uint64(48 - bits), buckets))])

    def reply(asked: pa.Table, stored: pa.Table) -> pa.Table:
        stage = asked.column("stage").to_numpy()
        blobs, out = asked.column("data"), [b""] * asked.num_rows
        asks = [(i, from_planes(names), stops) for i in np.flatnonzero(stage == 0) for names, stops in [_open(blobs[int(i)].as_py())]]
        if asks:
            model = fitted.value
            own = Words.unpacked(stored.column("data")[0].as_py())
            used = np.zeros(len(own.name), np.uint8)
            for _, names, stops in asks:
                used[np.searchsorted(own.name, names)] |= stops
            cells = _cells(used)
            costs = census.bits(own.counts, model.spelling(own, cells)).astype(np.float32)
            seen = own.counts.sum(axis=1) * (own.sizes > 0)
            for i, names, stops in asks:
                at = np.searchsorted(own.name, names)
                marked = _cells(stops)
                out[i] = _squeeze(byte_planes(seen[at].astype(np.uint32)), costs[at][marked], byte_planes(own.counts[at][marked]))
        which = np.flatnonzero(stage == 1)
        if len(which):
            parts = [_open(blobs[int(i)].as_py()) for i in which]
            counts = [from_byte_planes(p[1], np.uint32) for p in parts]
            keys = [from_planes(p[0]) for p in parts]
            all_keys, place = np.unique(np.concatenate(keys), return_inverse=True)
            pair = np.bincount(place, np.concatenate(counts), len(all_keys))
            context = all_keys >> np.uint64(CLASS_BITS)
            begin = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            total = np.repeat(np.add.reduceat(pair, begin), np.diff(np.append(begin, len(context))))
            ends = np.cumsum([len(k) for k in keys])
            for i, k, e in zip(which, keys, ends):
                own = place[e - len(k):e]
                out[i] = _squeeze(*[byte_planes(x[own].astype(np.uint32)) for x in (pair, total)])
        return asked.set_column(asked.schema.get_field_index("data"), "data", pa.array(out, pa.binary()))

    def finish(table: pa.Table, chunk: int, answers: list) -> pa.Table:
        parts = list(slices(ch.parts_of(table)))
        all_units, keys, place = seen_pairs(parts)
        contexts = (keys >> np.uint64(CLASS_BITS)).astype(np.int64)
        ends = np.cumsum([len(u.stop) for u in all_units])
        names, (stops,) = _stops_used(all_units)
        seen, priced, occurred = answers[0]
        cells = _cells(stops)
        costs, counts = np.zeros(cells.shape), np.zeros(cells.shape, np.int64)
        costs[cells], counts[cells] = priced, occurred
        bare = Words(names, counts, np.zeros(len(names), np.int64), np.zeros(0, np.uint8))
        shares = class_shares(bare, totals.value).astype(np.float32).astype(np.float64)
        pair_count, context_count = answers[1]
        out = []
        for part, units, end in zip(parts, all_units, ends.tolist()):
            at = np.searchsorted(names, units.names)[units.place]
            word = units.sizes > 0
            add = lambda x: np.bincount(units.doc, x, units.docs)
            tokens, known = add(word) + 1, add(word & (seen[at] > 0)) + (texts > 0)
            base = add(np.where(word, np.log10(seen[at] + 0.1), 0.0)) + np.log10(texts + 0.1) \
                - tokens * np.log10(total + 0.1 * (distinct + 1))
            key = place[end - len(units.stop):end]
            pair, context = pair_count[key], context_count[key]
            less_pair, less_context = _own_counts(key, contexts[key], units.doc, _learned(part)[units.doc])
            begins = np.concatenate([[True], units.doc[1:] != units.doc[:-1]])
            paid = add(with_context(costs[at, units.stop], pair - less_pair, context - less_context, begins,
                                    shares[at, units.stop]))
            size = add(units.sizes + (units.stop != END))
            out.append(pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(x.astype(np.int64)) for x in (tokens, known, np.full(units.docs, total))],
                 pa.array(base), pa.array(-paid * np.log10(2.0)), pa.array(size.astype(np.int64)), pa.array(paid / np.maximum(size, 1))],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]))
        return pa.Table.from_batches(out)

    asked = ch.ask(rows, ask)
    answers = ch.by_bucket(asked, buckets).groupBy("bucket").cogroup(words.select("bucket", "data").groupBy("bucket")).applyInArrow(
        lambda a, w: reply(a, w) if a.num_rows else a, ch.BLOCK)
    return ch.ask(rows, finish, answers, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                         "base_score double, score double, n_bytes bigint, bits_per_byte double", plain_counts, _open)
