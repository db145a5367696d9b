"""Language-model scores from an Elias-Fano n-gram trie.

The model is a bigram model with absolute discounting: a pair seen in training has probability
(count - DISCOUNT) / count of its context, any other gets DISCOUNT * distinct successors / count of
the context, times the smoothed unigram probability (c + 0.5) / (N + 0.5 * (V + 1)) of the word. A
context never seen leaves the unigram alone. Texts begin with a begin mark and close with an end
token, which is scored.

Three passes, none of which gathers more than a shard:

1. count the words of the training documents; words too frequent for one shard are listed, and of
   the pairs of listed words those too frequent are counted in a second scan;
2. deal every pair, with its document, to the shard of its context (pairs with a listed context by
   both words, so that it spreads; listed pairs are scored where they are). A shard builds its
   trie from its training pairs and scores all its pairs, training and held out;
3. words that need the unigram part meet its count in the shard of the word; sums per document meet
   by block of documents.

A shard's trie has two levels in a memory-mapped file: contexts, monotone pointers into the
successors, and successors, all Elias-Fano coded, with probabilities quantised to 1/4096 of a
decade. A pair is looked up by the successor search within the range of its context. Words are
64-bit hashes.

Defined results: a null or blank text is the end token alone; a null document id is never held out
by ``held_out``; repeated rows each count and are each scored; with no training documents all counts
are 0. The lists are bounded: at most 4 words, and 4 pairs, for each shard.
"""

import math
import tempfile
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from galewire.llm.decontamination import shards as text_blocks
from galewire.sources.scratch import materialize

DISCOUNT = 0.75
STEPS = 4096  # quantised parts of a decade
SHARD_TOKENS = 1_500_000
FLUSH = 400_000

BEGIN, END = b" begin", b" end"  # words hold no blank


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def tokens(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


# ---------------------------------------------------------------- Elias-Fano


class EliasFano:
    """A sorted list of whole numbers below ``universe``: low bits packed, high bits in unary."""

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n, self.bits = n, max(0, int(universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = values & np.uint64((1 << self.bits) - 1)
        self.low = np.zeros(n * self.bits // 64 + 2, np.uint64)
        if self.bits and n:
            at = np.arange(n, dtype=np.int64) * self.bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            self.low[word[first]] = np.bitwise_or.reduceat(low << shift, first)
            over = (at & 63) + self.bits > 64
            # At most one number reaches into the next word.
            self.low[word[over] + 1] |= low[over] >> (np.uint64(64) - shift[over])
        top = (values >> np.uint64(self.bits)).astype(np.int64) + np.arange(n)
        size = n + (int(universe) >> self.bits) + 2
        unary = np.zeros(-(-size // 64) * 64, np.uint8)
        unary[top] = 1
        self.high = np.packbits(unary, bitorder="little").view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(self.high).astype(np.int64))))
        self.ones, self.zeros = ones, np.arange(len(ones)) * 64 - ones

    def parts(self) -> list[str]:
        return ["low", "high", "ones", "zeros"]

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """The place of the k-th (from 0) one or zero."""
        before = self.ones if one else self.zeros
        word = np.searchsorted(before, k, "right") - 1
        left = k - before[word]
        bits = self.high[word]
        if not one:
            bits = ~bits
        at = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            go = left >= here
            left = np.where(go, left - here, left)
            bits = np.where(go, bits >> np.uint64(width), bits)
            at += go * width
        return word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        next_ = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (value | next_) & np.uint64((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        top = self._select(i, True) - i
        return (top << self.bits) | self._low(i).astype(np.int64)

    def find(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Where each x is, within [first, last) if given, or -1: successor search by high part."""
        x = x.astype(np.int64)
        h = x >> self.bits
        a = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - np.maximum(h - 1, 0), 0)
        b = self._select(h, False) - h
        if first is not None:
            a, b = np.maximum(a, first), np.minimum(b, last)
        end, wanted = b.copy(), (x & ((1 << self.bits) - 1)).astype(np.uint64)
        while (open_ := a < b).any():
            middle = np.where(open_, (a + b) >> 1, 0)
            less = open_ & (self._low(middle) < wanted)
            a = np.where(less, middle + 1, a)
            b = np.where(open_ & ~less, middle, b)
        hit = a < end
        hit[hit] = self._low(a[hit]) == wanted[hit]
        return np.where(hit, a, -1)


class Trie:
    """Contexts, pointers and successors of one shard, read from a memory-mapped file."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, size: int, context_counts: np.ndarray):
        """``pairs``: sorted context * size + successor; ``context_counts`` by context."""
        owner = pairs // size
        contexts, starts = np.unique(owner, return_index=True)
        self.size = size
        rank = np.searchsorted(contexts, owner)
        self.contexts = EliasFano(contexts, size)
        self.pointers = EliasFano(np.append(starts, len(pairs)), len(pairs) + 1)
        # Successors made one rising list: context number * size + successor.
        self.successors = EliasFano(rank * size + pairs % size, max(1, len(contexts) * size))
        p = np.log10((counts - DISCOUNT) / context_counts[owner])
        self.codes = np.round(-p * STEPS).astype(np.uint16)
        self.distinct = np.diff(np.append(starts, len(pairs)))

    def mapped(self, file) -> "Trie":
        """The same, with all arrays moved to ``file`` and mapped from it."""
        places = []
        for level in (self.contexts, self.pointers, self.successors):
            places += [(level, name) for name in level.parts()]
        places.append((self, "codes"))
        at = 0
        kept = []
        for owner, name in places:
            array = getattr(owner, name)
            file.write(array.tobytes())
            pad = -array.nbytes % 8
            file.write(b"\0" * pad)
            kept.append((owner, name, array.dtype, len(array), at))
            at += array.nbytes + pad
        file.flush()
        for owner, name, dtype, n, start in kept:
            if n:
                setattr(owner, name, np.memmap(file, dtype, "r", start, n))
        return self

    def lookup(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context number (-1: unknown) and log10 probability (nan: not a pair of the trie)."""
        if not self.contexts.n:
            return np.full(len(pairs), -1), np.full(len(pairs), np.nan)
        context = self.contexts.find(pairs // self.size)
        k = np.maximum(context, 0)
        first, last = self.pointers.access(k), self.pointers.access(k + 1)
        at = self.successors.find(k * self.size + pairs % self.size, first, last)
        at = np.where(context >= 0, at, -1)
        p = -self.codes[np.maximum(at, 0)].astype(np.float64) / STEPS
        return context, np.where(at >= 0, p, np.nan)


# ---------------------------------------------------------------- packed rows


def pack(*arrays: np.ndarray) -> bytes:
    head = "".join(f"{a.dtype.str}:{len(a)};" for a in arrays).encode()
    body = len(head).to_bytes(4, "little") + head + b"".join(a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    size = int.from_bytes(body[:4], "little")
    at, out = 4 + size, []
    for part in body[4:at].decode().split(";")[:-1]:
        kind, n = part.split(":")
        array = np.frombuffer(body, np.dtype(kind), int(n), at)
        out.append(array)
        at += array.nbytes
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint16 if not len(a) or a.max() < 1 << 16 else np.uint32)


ROWS = "kind int, key long, n long, blob binary"
_SCHEMA = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("blob", pa.binary())])
PAIRS, DOCS, SUMS, WORDS, COUNTS, SUCCESSORS = range(6)


def _row(kind: int, key: int, n: int = 0, blob: bytes | None = None) -> dict:
    return {"kind": kind, "key": key, "n": n, "blob": blob}


def _spread(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


class _Words(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _find(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, at, -1)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes; products wrap around."""
    x = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


# ---------------------------------------------------------------- pass 1: words


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training words, with BEGIN and END once a document; n tokens of all documents in row 0."""
    counts: Counter = Counter()
    total = 0

    def out(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, _SCHEMA)

    def words() -> pa.RecordBatch:
        keys = np.array([word_hash(w) for w in counts], np.uint64).view(np.int64)
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, WORDS, np.int32)), pa.array(keys), pa.array(np.array(list(counts.values()), np.int64)),
             pa.nulls(n, pa.binary())], schema=_SCHEMA)

    for batch in batches:
        texts = pc.cast(batch.column("lm_text"), pa.binary())
        for text, held in zip(texts, batch.column("held").to_pylist()):
            found = tokens(text.as_py())
            total += len(found) + 1
            if not held:
                counts.update(found)
                counts.update((BEGIN, END))
            if len(counts) > FLUSH:
                yield words()
                counts.clear()
    if counts:
        yield words()
    yield out([_row(DOCS, 0, total)])


class Listed:
    """Words, and pairs of them, that are too frequent for one shard; and the corpus's totals."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, distinct: int, shards: int):
        self.words, self.counts = words, counts  # sorted by hash
        self.pairs = self.pair_counts = np.empty(0, np.int64)
        self.total, self.distinct, self.shards = total, distinct, shards
        self.begin, self.end = word_hash(BEGIN), word_hash(END)

    @property
    def share(self) -> float:
        """The divisor of a smoothed unigram probability."""
        return self.total + 0.5 * (self.distinct + 1)


def _sequences(texts: Sequence[bytes | None]):
    """Contexts and successors of a block as word numbers, their document, and the numbers' hashes."""
    vocabulary = _Words()
    begin, end = vocabulary[BEGIN], vocabulary[END]
    context, after, doc = [], [], []
    sizes = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        found = tokens(text)
        ids = np.fromiter(map(vocabulary.__getitem__, found), np.int64, len(found))
        context.append(np.concatenate(([begin], ids)))
        after.append(np.concatenate((ids, [end])))
        sizes[k] = len(found) + 1
    doc = np.repeat(np.arange(len(texts)), sizes)
    hashes = np.fromiter((word_hash(w) for w in vocabulary), np.uint64, len(vocabulary))
    return np.concatenate(context), np.concatenate(after), doc, sizes, hashes


def _count_pairs(listed: Listed):
    """Pairs of listed words in training documents."""
    n = len(listed.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.array(batch.column("held").to_pylist(), bool)
            texts = pc.cast(batch.column("lm_text"), pa.binary()).to_pylist()
            texts = [t for t, h in zip(texts, held) if not h]
            for cut in text_blocks(texts):
                context, after, _, _, hashes = _sequences(texts[cut])
                place = _find(listed.words, hashes)
                a, b = place[context], place[after]
                both = (a >= 0) & (b >= 0)
                code, count = np.unique(a[both] * n + b[both], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(code), PAIRS, np.int32)), pa.array(code), pa.array(count.astype(np.int64)),
                     pa.nulls(len(code), pa.binary())], schema=_SCHEMA)

    return run


# ---------------------------------------------------------------- pass 2: pairs


def _deal(listed: Listed):
    """Blocks of documents into one packed row per shard, and one with the documents themselves."""

    def block(rows: pa.Array, texts: list[bytes | None], held: np.ndarray, number: int) -> Iterator[dict]:
        context, after, doc, sizes, hashes = _sequences(texts)
        place = _find(listed.words, hashes)
        count = np.where(place >= 0, listed.counts[np.maximum(place, 0)] if len(listed.counts) else 0, 0)
        a, b = place[context], place[after]
        code = np.where((a >= 0) & (b >= 0), a * len(listed.words) + b, -1)
        known = _find(listed.pairs, code)
        here = known >= 0
        p = np.zeros(len(context))
        if here.any():
            p[here] = np.log10((listed.pair_counts[known[here]] - DISCOUNT) / count[context[here]])
        # Listed contexts are counted here; the others where their counts are.
        own = (a >= 0) & (hashes[context] != np.uint64(listed.begin))
        base = np.where(own, np.log10(count[context] + 0.5), 0.0)
        n = len(texts)
        sums = [np.bincount(doc, w, n) for w in (p, base, own.astype(float))]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("row", rows.type)])) as out:
            out.write_batch(pa.RecordBatch.from_arrays([rows], names=["row"]))
        yield _row(DOCS, number % listed.shards, number, pack(
            sizes, *sums, np.frombuffer(sink.getvalue(), np.uint8)))
        left = np.flatnonzero(~here)
        context, after, a = context[left], after[left], a[left]
        mark = doc[left] * 2 + ~held[doc[left]]
        key = np.where(a >= 0, _mixed(hashes[context], hashes[after]), hashes[context])
        shard = _spread(key, listed.shards)
        order = np.argsort(shard.astype(np.int32), kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(listed.shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[s] : cuts[s + 1]]
            used, local = np.unique(np.concatenate((context[at], after[at])), return_inverse=True)
            local = narrow(local)
            yield _row(PAIRS, int(s), number, pack(
                hashes[used], local[: len(at)], local[len(at) :], narrow(np.diff(mark[at], prepend=0))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            held = np.array(batch.column("held").to_pylist(), bool)
            texts = pc.cast(batch.column("lm_text"), pa.binary()).to_pylist()
            for cut in text_blocks(texts):
                rows = batch.column("row").slice(cut.start, cut.stop - cut.start)
                for row in block(rows, texts[cut], held[cut], number):
                    yield pa.RecordBatch.from_pylist([row], _SCHEMA)
                number += 1

    return run


def _score_shard(listed: Listed):
    """One shard: its trie, the sums of its pairs by document, the words that need their unigram
    probability, its word counts, and the listed contexts' distinct successors."""

    def run(table: pa.Table) -> pa.Table:
        out: list[dict] = []
        words, parts = [], []
        for kind, number, blob in zip(*(table.column(c).to_pylist() for c in ("kind", "n", "blob"))):
            if kind == DOCS:
                out.append(_row(DOCS, number, 0, blob))
                continue
            hashes, context, after, step = unpack(blob)
            words.append(hashes)
            parts.append((number, context, after, np.cumsum(step.astype(np.int64))))
        if not parts:
            return pa.Table.from_pylist(out, _SCHEMA)
        vocabulary, place = np.unique(np.concatenate(words), return_inverse=True)
        shift = np.cumsum([0] + [len(w) for w in words])
        context = np.concatenate([place[shift[k] + p[1]] for k, p in enumerate(parts)])
        after = np.concatenate([place[shift[k] + p[2]] for k, p in enumerate(parts)])
        mark = np.concatenate([p[3] for p in parts])
        block = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        doc, train = mark >> 1, (mark & 1).astype(bool)
        size = len(vocabulary)
        hot = _find(listed.words, vocabulary)
        counts = np.bincount(context[train], minlength=size)
        counts = np.where(hot >= 0, listed.counts[np.maximum(hot, 0)] if len(listed.counts) else 0, counts)
        pair = context * size + after
        seen, times = np.unique(pair[train], return_counts=True)
        asked, back = np.unique(pair, return_inverse=True)
        with tempfile.TemporaryFile() as file:
            trie = Trie(seen, times, size, counts).mapped(file)
            found, p = trie.lookup(asked)
            distinct = trie.distinct
            del trie
        owner, word = asked // size, asked % size
        missing = np.isnan(p)
        cold = hot[owner] < 0
        p = np.where(missing, 0.0, p)
        some = missing & cold & (found >= 0)
        p[some] = np.log10(DISCOUNT * distinct[found[some]] / counts[owner[some]])
        # A listed word's unigram count is known everywhere.
        listed_word = missing & (hot[word] >= 0)
        p[listed_word] += np.log10((counts[word[listed_word]] + 0.5) / listed.share)
        base = np.where((hot < 0) & (counts >= 0), np.log10(counts + 0.5), 0.0)[context]
        known = ((hot < 0) & (counts > 0))[context]
        base[hot[context] >= 0] = 0.0
        first = np.flatnonzero(np.diff(block, prepend=-1) | np.diff(doc, prepend=-1))
        sums = [np.add.reduceat(x, first) for x in (p[back], base, known.astype(np.float64))]
        cuts = np.searchsorted(block[first], np.arange(len(parts) + 1))
        for k, part in enumerate(parts):
            at = slice(cuts[k], cuts[k + 1])
            # Scores are quantised anyway, so a short float holds a shard's part of one.
            score, base_part, known_part = (x[at] for x in sums)
            out.append(_row(SUMS, part[0], 0, pack(
                narrow(doc[first[at]]), score.astype(np.float32), base_part, narrow(known_part.astype(np.int64)))))
        # What is left: words to be looked up by their own shard, and listed contexts' shares.
        ask = np.flatnonzero((missing & (~cold | (hot[word] < 0)))[back])
        numbers = np.array([part[0] for part in parts], np.int64)
        w = vocabulary[after[ask]]
        again = np.where(hot[after[ask]] >= 0, np.uint64(0), w)
        target = _spread(np.where(again == 0, _mixed(w, doc[ask].astype(np.uint64)), w), listed.shards)
        backoff = hot[context[ask]]
        order = np.argsort(target, kind="stable")
        edges = np.searchsorted(target[order], np.arange(listed.shards + 1))
        for s in np.flatnonzero(np.diff(edges)):
            at = order[edges[s] : edges[s + 1]]
            out.append(_row(WORDS, int(s), 0, pack(
                numbers, narrow(block[ask[at]]), narrow(doc[ask[at]]), again[at], backoff[at].astype(np.int32))))
        own = np.flatnonzero((hot < 0) & (counts > 0))
        home = _spread(vocabulary[own], listed.shards)
        for s in np.unique(home):
            at = own[home == s]
            out.append(_row(COUNTS, int(s), 0, pack(vocabulary[at], counts[at])))
        own_hot = hot[seen // size]
        for k, n in zip(*np.unique(own_hot[own_hot >= 0], return_counts=True)):
            out.append(_row(SUCCESSORS, int(k), int(n)))
        return pa.Table.from_pylist(out, _SCHEMA)

    return run


def _unigrams(listed: Listed, distinct: np.ndarray):
    """One shard of words: what each asking document gets, as sums by block. ``distinct``: distinct
    successors of the listed words."""

    def run(table: pa.Table) -> pa.Table:
        words, counts, asked = [], [], []
        for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
            if kind == COUNTS:
                w, n = unpack(blob)
                words.append(w)
                counts.append(n)
            else:
                asked.append(unpack(blob))
        key = np.concatenate([np.empty(0, np.uint64), *words])
        order = np.argsort(key)
        key, n = key[order], np.concatenate([np.empty(0, np.int64), *counts])[order]
        out = []
        sums: dict[int, list] = {}
        for numbers, block, doc, word, context in asked:
            at = _find(key, word)
            c = np.where(at >= 0, n[np.maximum(at, 0)] if len(n) else 0, 0)
            p = np.where(word == 0, 0.0, np.log10((c + 0.5) / listed.share))
            listed_context = (context >= 0) & (listed.counts[np.maximum(context, 0)] > 0)
            k = context[listed_context]
            p[listed_context] += np.log10(DISCOUNT * np.maximum(distinct[k], 1) / listed.counts[k])
            by = np.argsort(block, kind="stable")
            cuts = np.searchsorted(block[by], np.arange(len(numbers) + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                own = by[cuts[b] : cuts[b + 1]]
                sums.setdefault(int(numbers[b]), []).append((doc[own].astype(np.int64), p[own]))
        for number, found in sums.items():
            doc = np.concatenate([d for d, _ in found])
            total = np.bincount(doc, np.concatenate([p for _, p in found]))
            used = np.unique(doc)
            none = np.zeros(len(used), np.uint8)
            out.append(_row(SUMS, number, 0, pack(narrow(used), total[used].astype(np.float32), none, none)))
        return pa.Table.from_pylist(out, _SCHEMA)

    return run


# ---------------------------------------------------------------- pass 3: documents


def _finish(listed: Listed, row_type: pa.DataType):
    schema = pa.schema([("row", row_type), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])
    end = int(listed.counts[_find(listed.words, np.array([listed.end], np.uint64))[0]])

    def run(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        docs = [unpack(b) for k, b in zip(kinds, blobs) if k == DOCS]
        sizes, p, base, known, stream = docs[0]
        total = [x.copy() for x in (p, base, known)]
        for kind, blob in zip(kinds, blobs):
            if kind == SUMS:
                doc, *parts = unpack(blob)
                for x, part in zip(total, parts):
                    x[doc] += part
        rows = pa.ipc.open_stream(stream.tobytes()).read_all().column("row").combine_chunks()
        # log10(0 + 0.5) for every token of an unknown word is in the sums; the end token is not.
        base = total[1] + math.log10(end + 0.5) - sizes * math.log10(listed.share)
        return pa.Table.from_arrays(
            [rows, pa.array(sizes), pa.array(np.round(total[2]).astype(np.int64) + (end > 0)), pa.array(base),
             pa.array(total[0])], schema=schema)

    return run


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def score(
    docs: DataFrame,
    held: Column,
    carry: Sequence[str] = ("doc_id",),
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """``row`` (the columns carried), ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` of every document, learned from those that ``held`` does not hold out."""
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(f"`{text}`").alias("lm_text"),
        held.alias("held"),
    )
    begin, end = (int(np.uint64(word_hash(x)).view(np.int64)) for x in (BEGIN, END))
    counted = materialize(
        source.select("lm_text", "held").mapInArrow(_count_words, ROWS)
        .groupBy("kind", "key").agg(F.sum("n").alias("n")),
        "lm-words",
    )
    words = counted.filter(F.col("kind") == WORDS)
    everything = counted.filter(F.col("kind") == DOCS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    distinct, total = words.filter(F.col("key") != begin).agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    shards = max(1, math.ceil(everything / shard_tokens))
    often = words.filter((F.col("n") >= shard_tokens // 4) | F.col("key").isin(begin, end))
    found = often.select("key", "n").collect()  # at most 4 for each shard, and the two marks
    counts = {begin: 0, end: 0} | {r["key"]: r["n"] for r in found}
    keys = np.array(list(counts), np.int64).view(np.uint64)
    order = np.argsort(keys)
    listed = Listed(keys[order], np.array(list(counts.values()), np.int64)[order], total, distinct, shards)
    pairs = (
        source.select("lm_text", "held").mapInArrow(_count_pairs(listed), ROWS)
        .groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= shard_tokens // 4).orderBy("key").collect()
    )
    listed.pairs = np.array([r["key"] for r in pairs], np.int64)
    listed.pair_counts = np.array([r["n"] for r in pairs], np.int64)

    dealt = source.mapInArrow(_deal(listed), ROWS)
    scored = materialize(dealt.groupBy("key").applyInArrow(_score_shard(listed), ROWS), "lm-shards")
    successors = np.bincount(listed.pairs // max(len(keys), 1), minlength=len(keys))
    spread = scored.filter(F.col("kind") == SUCCESSORS).groupBy("key").agg(F.sum("n").alias("n"))
    for key, n in spread.collect():  # listed words
        successors[key] += n
    asked = scored.filter(F.col("kind").isin(WORDS, COUNTS))
    backed = asked.groupBy("key").applyInArrow(_unigrams(listed, successors), ROWS)
    by_block = scored.filter(F.col("kind").isin(DOCS, SUMS)).unionByName(backed)
    schema = T.StructType([
        source.schema["row"],
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])
    row_type = to_arrow_type(source.schema["row"].dataType)
    return (
        by_block.groupBy("key").applyInArrow(_finish(listed, row_type), schema)
        .withColumn("train_tokens", F.lit(int(total)).cast("long"))
    )

