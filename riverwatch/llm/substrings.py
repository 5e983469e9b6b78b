"""Substring dedup: repeated paragraphs and passages by MinHash banding.

Units are the lines of a text, their sentences, and word windows over the whole
text that hang neither on line nor on sentence ends. Lines and windows are
compared by Jaccard similarity: MinHash bands propose, exact shingle sets
decide. Sentences and seeds (short windows) have to be equal; around equal
seeds the windows at every word are compared. Units joined by links form
clusters (components); all but a cluster's first unit may be removed.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverwatch.llm import common
from riverwatch.llm.common import bounded_batches, drop_part, drop_stored, table
from riverwatch.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.995
ROWS = 2             # MinHash rows in a band
LINE_WORDS = 5       # shorter lines are compared in the windows and seeds they lie in
SENTENCE_WORDS = 5   # shorter sentences too
PASSAGE_WORDS = 30   # shorter runs are not reported if no repeated line is in them
GAP_WORDS = 8        # a run goes on over so many words that are no unit of their own
WINDOW_WORDS = 50    # words of a window that is compared by similarity
WINDOW_APART = 10    # windows start more words apart than this, so those of one text are not similar
SEED_WORDS = 16      # words of a window that is compared by equality
SEED_APART = 15      # of so many starts one after the other at least one is taken
BAND_PARTS = 2       # bands are dealt to so many parts; only one part's rows are on disk at a time
GROUP_PARTS = 2      # groups of colliding units are compared in so many parts, for the same reason
BLOCK = 256          # lines of one bucket that are compared at once; larger buckets are split around centres
ROUNDS = 4           # splits of a bucket; what is still larger than a block goes by pairs of blocks
CENTRE_SAMPLE = 32   # about so many lines of a bucket decide where its centre is looked for
LINE, SENTENCE, WINDOW, SEED, KEYS = 0, 1, 2, 3, 4  # keys: the band keys of a line or window, told apart from it
APART = 64           # free word numbers after each text of a batch, more than any rule looks away
SLICE = 1 << 20      # bytes of text that are taken apart at once; a longer text is taken alone
CHUNK = 1 << 18      # bytes whose words are hashed at once
LONG_WORD = 4096     # bytes; longer words are hashed one by one

_STEP = 0x9E3779B97F4A7C15  # odd: the base of the hashes of word ranges
_BACK = pow(_STEP, -1, 1 << 64)


#: Tables whose shuffle files go as soon as they are written.
stored = functools.partial(common.stored, free_shuffles=True)


def bands_for(similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> int:
    """The least number of bands that finds a pair at ``similarity`` with chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))


@functools.cache
def _odd_numbers(n: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"minhash {i}") | 1 for i in range(n)], dtype=np.uint64)


def keys_of(minima: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """Band keys (units x bands) of the MinHash minima (bands * rows x units)."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    for r in range(rows):
        keys = (keys ^ minima[r::rows]) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
    return keys.T


def band_keys(hashes: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """One key for each band of the MinHash signature."""
    spread = hashes[None, :] * _odd_numbers(bands * rows)[:, None]
    low = (spread ^ (spread >> np.uint64(29))).min(axis=1)
    return keys_of(low[:, None], bands, rows)[0]


@functools.cache
def _byte_values() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"byte {i}") | 1 for i in range(256)], dtype=np.uint64)


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@functools.cache
def _few_powers(base: int) -> np.ndarray:
    return _powers_of(base, CHUNK + LONG_WORD + 1)


def _powers(base: int, n: int) -> np.ndarray:
    few = _few_powers(base)
    return few[:n] if n <= len(few) else _powers_of(base, n)


def _is_one_of(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_INNER = ~_is_one_of(b" \t\n\x0b\f\r")
_STOP, _CLOSING = _is_one_of(b".!?"), _is_one_of(b"\"')]")


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins (and the last ends)."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def _edges(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words start and end; a word never goes on in the next text."""
    inner = _INNER[data]
    first, last = inner.copy(), inner.copy()
    first[1:] &= ~inner[:-1]
    last[:-1] &= ~inner[1:]
    some = at[1:] > at[:-1]
    first[at[:-1][some]] = inner[at[:-1][some]]
    last[at[1:][some] - 1] = inner[at[1:][some] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, chunk by chunk, so that a very long text needs no more memory."""
    out = np.zeros(len(starts), dtype=np.uint64)
    short = np.minimum(ends, starts + LONG_WORD)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + CHUNK, CHUNK))
    for i, j in zip(cuts[:-1], cuts[1:]):
        if i < j:
            lo, hi = starts[i], short[j - 1]
            sums = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(_byte_values()[data[lo:hi]] * _powers(_STEP, hi - lo), out=sums[1:])
            first = starts[i:j] - lo
            out[i:j] = (sums[short[i:j] - lo] - sums[first]) * _powers(_BACK, hi - lo + 1)[first]
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes())
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


class Words:
    """The words of a column of texts (lower-cased, between ASCII white space) with places and hashes.

    The words of all texts are numbered through; ``APART`` numbers after each text are left free, so
    that nothing that looks at neighbours sees the next text. Text ``i`` has the numbers from
    ``base[i]`` up to ``stop[i]``. ``numbers`` are those of all words, ``text`` their texts.
    """

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "")
        self.data, at = _bytes_of(column)
        self.first, self.last = _edges(self.data, at)
        plain = not (self.data >= 128).any()
        lower, lower_at = _bytes_of(pc.ascii_lower(column) if plain else pc.utf8_lower(column))
        own = _word_hashes(lower, *((self.first, self.last) if plain else _edges(lower, lower_at)))
        count = np.searchsorted(self.first, at)
        texts = np.arange(len(column))
        self.base, self.stop = count[:-1] + APART * texts, count[1:] + APART * texts
        self.text = np.repeat(texts, np.diff(count))
        self.numbers = np.arange(len(own)) + APART * self.text
        self.size = len(own) + APART * len(column)
        self._plain, self._at = plain, at
        spread = np.zeros(self.size, dtype=np.uint64)
        spread[self.numbers] = own
        self._sums = np.zeros(self.size + 1, dtype=np.uint64)
        np.cumsum(spread * _powers(_STEP, self.size), out=self._sums[1:])
        self._back = _powers(_BACK, self.size + 1)

    @functools.cached_property
    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Where in its text each word starts and ends, in code points."""
        starts, ends = np.zeros((2, self.size), dtype=np.int64)
        first, last, zero = self.first, self.last, self._at
        if not self._plain:  # from bytes to code points
            points = np.zeros(len(self.data) + 1, dtype=np.int64)
            np.cumsum((self.data & 0xC0) != 0x80, out=points[1:])
            first, last, zero = points[first], points[last], points[zero]
        zero = zero[self.text]
        starts[self.numbers] = first - zero
        ends[self.numbers] = last - zero
        return starts, ends

    def text_at(self, numbers: np.ndarray) -> np.ndarray:
        """The text that a number belongs to."""
        return np.searchsorted(self.base, numbers, "right") - 1

    def hashes(self, first: np.ndarray, after: np.ndarray, kind: int) -> np.ndarray:
        """Hashes of the word ranges, the same wherever in a text equal words stand."""
        own = (self._sums[after] - self._sums[first]) * self._back[first]
        own += (after - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(kind)
        for _ in range(2):
            own = (own ^ (own >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return own ^ (own >> np.uint64(32))

    def windows(self, first: np.ndarray, size: int, kind: int) -> np.ndarray:
        return self.hashes(first, first + size, kind)

    def parts(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """First word and word after of the lines, and of the sentences in them.

        A sentence ends with its line, or after a word with one of ``.!?`` at its end (closing
        quotes and brackets may follow).
        """
        if not len(self.numbers):
            none = np.zeros(0, dtype=np.int64)
            return (none, none), (none, none)
        line = np.searchsorted(np.flatnonzero(self.data == 10), self.first)
        new = np.ones(len(line), dtype=bool)
        new[1:] = (np.diff(line) != 0) | (np.diff(self.text) != 0)
        at = self.last - 1
        closed = np.flatnonzero(_CLOSING[self.data[at]])
        if len(closed):
            open_ = np.flatnonzero(~_CLOSING[self.data])
            before = np.searchsorted(open_, at[closed], "right") - 1
            at[closed] = np.append(open_, -1)[before]
        end = (at >= self.first) & _STOP[self.data[at]]

        def ranges(starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
            first = np.flatnonzero(starts)
            after = np.append(first[1:], len(starts))
            kept = after - first >= least
            return self.numbers[first[kept]], self.numbers[after[kept] - 1] + 1

        lines = ranges(new, LINE_WORDS)
        new[1:] |= end[:-1]
        return lines, ranges(new, SENTENCE_WORDS)


def _range_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` values that follow one another, by doubling."""
    done, out = 1, values
    while done < size:
        step = min(done, size - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def window_starts(ranks: np.ndarray, apart: int = WINDOW_APART) -> np.ndarray:
    """Places whose rank is the least of those up to ``apart`` away; of equals the first."""
    if not len(ranks):
        return np.zeros(0, dtype=np.int64)
    most = np.full(apart, np.iinfo(np.uint64).max, dtype=np.uint64)
    low = _range_minima(np.concatenate([most, ranks, most]), apart)
    return np.flatnonzero((ranks < low[:len(ranks)]) & (ranks <= low[apart + 1:][:len(ranks)]))


def seed_starts(ranks: np.ndarray, left: np.ndarray, own: np.ndarray, among: int = SEED_APART) -> np.ndarray:
    """The places of the least of each ``among`` ranks that follow one another in a text; of equals the first.

    ``left``: how many ranks the text has from a place on; ``own``: how many in all. Of a text
    with fewer than ``among`` the least of all.
    """
    if len(ranks) < among:
        return np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(((left >= among) | ((left == own) & (own > 0)))[:len(ranks) - among + 1])
    done, low, place = 1, ranks, np.arange(len(ranks))
    while done < among:  # by doubling, as in _range_minima
        step = min(done, among - done)
        later = low[step:] < low[:-step]
        low = np.where(later, low[step:], low[:-step])
        place = np.where(later, place[step:], place[:-step])
        done += step
    place = place[at]  # never goes back
    return place[np.append(True, place[1:] != place[:-1])] if len(place) else place


def units_of(words: Words, bands: int) -> Iterator[tuple]:
    """Arrays (kind, first word, word after, hash, band keys or None) for each kind, by word numbers.

    Which places start a window or a seed depends on the words around them alone, so
    they are the same in every text that shares the passage: each run of
    ``SEED_WORDS + SEED_APART - 1`` equal words holds an equal seed.
    """
    (line0, line1), (first, after) = words.parts()
    yield SENTENCE, first, after, words.hashes(first, after, SENTENCE), None
    # places of shingles; the free numbers and the last words of a text have none
    n = max(0, words.size - SHINGLE + 1)
    starts = np.arange(n)
    own = np.maximum(words.stop - words.base - SHINGLE + 1, 0)
    of = words.text_at(starts)
    left = np.maximum(words.stop[of] - SHINGLE + 1 - starts, 0) if n else starts
    grams = words.windows(starts, SHINGLE, 0)
    ranks = words.windows(starts, SHINGLE, 1)
    ranks[left == 0] = np.iinfo(np.uint64).max
    # the words that decide on the place are inside the window, also where its ends are not alike
    window = window_starts(ranks) - 2 * WINDOW_APART
    text = words.text_at(window + 2 * WINDOW_APART)
    window = window[(window >= words.base[text]) & (window + WINDOW_WORDS <= words.stop[text])]
    low, high = np.append(line0, window), np.append(line1, window + WINDOW_WORDS) - SHINGLE + 1
    if len(low):
        bounds = np.stack([low, high], axis=1).ravel()
        minima = np.zeros((bands * ROWS, len(low)), dtype=np.uint64)
        for i, factor in enumerate(_odd_numbers(bands * ROWS)):
            spread = grams * factor
            spread ^= spread >> np.uint64(29)
            minima[i] = np.minimum.reduceat(spread, bounds)[::2]
        k = len(line0)
        # keys of lines are even, those of windows odd: a window never meets a line
        keys = keys_of(minima, bands) & ~np.uint64(1)
        keys[k:] |= np.uint64(1)
        yield LINE, line0, line1, words.hashes(line0, line1, LINE), keys[:k]
        yield WINDOW, window, window + WINDOW_WORDS, words.windows(window, WINDOW_WORDS, WINDOW), keys[k:]
    seed = seed_starts(ranks, left, own[of] if n else starts)
    seed = seed[seed + SEED_WORDS <= words.stop[words.text_at(seed)]]
    yield SEED, seed, seed + SEED_WORDS, words.windows(seed, SEED_WORDS, SEED), None


def _slices(batch: pa.RecordBatch, texts: int, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes in column ``texts``; a longer text is one alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def find_units(docs: DataFrame, bands: int, id_col: str = "doc_id",
               text_col: str = "text", keys_apart: bool = False) -> DataFrame:
    """The units of all texts: row (a key of id and text), id, kind, place, words, hash and band keys.

    Positions are in code points; word numbers count through each text. A seed's ends are not
    needed, so not stored. ``keys_apart``: band keys come in rows (id, hash, bands) of kind ``KEYS``
    of their own, the other rows have none.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, 2):
                yield from pack(part, Words(part.column(2)))

    def pack(b: pa.RecordBatch, words: Words) -> Iterator[pa.RecordBatch]:
        for kind_, first, after, own, keys in units_of(words, bands):
            n = len(first)
            if not n:
                continue
            text = words.text_at(first)
            none = np.zeros(n, dtype=np.int64)
            starts, stops = words.places
            place = (none, none, first - words.base[text], none) if kind_ == SEED else (
                starts[first], stops[after - 1], first - words.base[text], after - words.base[text])
            at = pa.array(text)
            row, id_ = b.column(0).take(at), b.column(1).take(at)
            if keys is None or not keys_apart:
                yield rows(row, id_, kind_, place, own, keys)
            else:
                yield rows(row, id_, kind_, place, own, None)
                yield rows(pa.array(none), id_, KEYS, (none,) * 4, own, keys)

    def rows(row: pa.Array, id_: pa.Array, kind_: int, place: tuple, own: np.ndarray,
             keys: np.ndarray | None) -> pa.RecordBatch:
        n = len(own)
        ends = np.arange(n + 1) * (0 if keys is None else bands)
        values = np.zeros(0, dtype=np.int64) if keys is None else np.ascontiguousarray(keys).ravel().view(np.int64)
        return pa.record_batch(
            [row, id_, pa.array(np.full(n, kind_, dtype=np.int32)),
             *[pa.array(x) for x in place], pa.array(own.view(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))],
            names=["row", "id", "kind", "start", "end", "w0", "w1", "hash", "bands"])

    return docs.select(
        F.xxhash64(id_col, text_col).alias("row"), F.col(id_col).alias("id"),
        F.col(text_col).alias("text")).mapInArrow(
        run, f"row long, id {kind}, kind int, start long, end long, w0 long, w1 long, "
             "hash long, bands array<long>")


def _forest(sets: dict[int, set], similarity: float) -> Iterator[tuple[int, int]]:
    """Edges that join the units whose shingle sets are similar enough, as a spanning forest."""
    left = sorted(sets)
    while left:
        root, left = left[0], left[1:]
        todo = [root]
        while todo and left:
            a, rest = sets[todo.pop()], []
            for x in left:
                b = sets[x]
                small, large = sorted((len(a), len(b)))
                shared = len(a & b) if small >= similarity * large else 0
                if shared >= similarity * (len(a) + len(b) - shared) and shared:
                    yield x, root
                    todo.append(x)
                else:
                    rest.append(x)
            left = rest


def _similar(own: np.ndarray, grams: pa.ListArray, first: np.ndarray, similarity: float) -> set[tuple[int, int]]:
    """The edges of groups of hashes and shingles that start at ``first``: pairs all at once, larger ones by ``_forest``."""
    sizes = pc.list_value_length(grams).to_numpy(zero_copy_only=False).astype(np.int64)
    values = grams.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    after = np.append(first[1:], len(own))
    edges = set()
    pair = first[after - first == 2]
    if len(pair):
        both = np.stack([pair, pair + 1], axis=1).ravel()
        of = np.repeat(np.arange(len(both)) // 2, sizes[both])
        starts = np.repeat(ends[both] - sizes[both] - np.append(0, np.cumsum(sizes[both])[:-1]), sizes[both])
        value = values[starts + np.arange(len(starts))]
        order = np.lexsort((value, of))
        value, of = value[order], of[order]
        equal = (value[1:] == value[:-1]) & (of[1:] == of[:-1])
        shared = np.bincount(of[1:][equal], minlength=len(pair))
        alike = (shared > 0) & (shared >= similarity * (sizes[pair] + sizes[pair + 1] - shared))
        edges.update(zip(own[pair[alike]].tolist(), own[pair[alike] + 1].tolist()))
    for i, j in zip(first, after):
        if j - i > 2:
            edges.update(_forest({int(own[k]): set(values[ends[k] - sizes[k]:ends[k]].tolist())
                                  for k in range(i, j)}, similarity))
    return edges


def _changes(*columns: pa.ChunkedArray) -> np.ndarray:
    """True where a row differs from the one before it in any of the columns; true for the first."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= pc.not_equal(c.slice(1), c.slice(0, max(0, len(c) - 1))).to_numpy(zero_copy_only=False)
    return new


def edges_of(batches: Iterator[pa.RecordBatch], similarity: float, least: int = 1 << 13) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of rows (group, hash, shingles) sorted by group and hash; the last group waits for the next rows."""
    def edges(t: pa.Table) -> pa.RecordBatch:
        t = t.filter(pa.array(_changes(t.column("group"), t.column("hash")))).combine_chunks()
        found = np.zeros((0, 2), dtype=np.int64)
        if t.num_rows:
            pairs = _similar(t.column("hash").to_numpy(), t.column("shingles").chunk(0),
                             np.flatnonzero(_changes(t.column("group"))), similarity)
            found = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= least:
            t = pa.Table.from_batches(held)
            last = int(np.flatnonzero(_changes(t.column("group")))[-1])
            yield edges(t.slice(0, last))
            held = t.slice(last).to_batches()
    if held:
        yield edges(pa.Table.from_batches(held))


def buckets_of(batches: Iterator[pa.RecordBatch], block: int, least: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Buckets of rows (key, hash, id) sorted by key and hash: (key, members, low, high, large).

    Members are the distinct hashes of a key that has two or more; ``low`` and ``high`` the extremes
    of their ids. A bucket of more than ``block`` members comes in parts of at most ``block``,
    all marked ``large``, so no more than that many of its members are held however many rows it has.
    """
    begun = None  # the key whose first parts are told already

    def buckets(t: pa.Table) -> pa.RecordBatch:
        key = t.column("key").to_numpy()
        first = np.flatnonzero(_changes(t.column("key")))
        size = np.diff(np.append(first, len(key)))
        told = (size > 1) | (key[first] == begun if begun is not None else False)
        t = t.filter(pa.array(np.repeat(told, size)))
        first, size, key = np.append(0, np.cumsum(size[told])[:-1]), size[told], key[first[told]]
        large = (size > block) | (key == begun if begun is not None else False)
        parts = -(-size // block)
        of = np.repeat(np.arange(len(size)), parts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.append(first[of] + block * nth, t.num_rows).astype(np.int32)
        low, high = ids_of(t, np.repeat(np.arange(len(of)), np.diff(at)))
        return pa.record_batch(
            [pa.array(key[of]), pa.ListArray.from_arrays(pa.array(at), t.column("hash").combine_chunks()),
             low, high, pa.array(large[of])], names=["key", "members", "low", "high", "large"])

    def ids_of(t: pa.Table, group: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """The least and greatest id of each group; Arrow gives groups in no certain order."""
        ids = pa.table([t.column("low"), t.column("high"), pa.array(group)], names=["low", "high", "group"]).group_by(
            "group").aggregate([("low", "min"), ("high", "max")]).sort_by("group")
        return ids.column("low_min").combine_chunks(), ids.column("high_max").combine_chunks()

    def units(t: pa.Table) -> pa.Table:
        new = _changes(t.column("key"), t.column("hash"))
        low, high = ids_of(t, np.cumsum(new))
        return pa.table([*t.select(["key", "hash"]).filter(pa.array(new)).columns, low, high], names=t.column_names)

    held, rows = [], 0
    for b in batches:
        held.append(pa.table([b.column(0), b.column(1), b.column(2), b.column(2)], names=["key", "hash", "low", "high"]))
        rows += b.num_rows
        if rows >= least:
            t = units(pa.concat_tables(held))
            last = int(np.flatnonzero(_changes(t.column("key")))[-1])
            if last:
                yield buckets(t.slice(0, last))
                t, begun = t.slice(last), None
            ready = (t.num_rows - 1) // block * block  # the last unit may go on
            if ready:
                begun = t.column("key")[0].as_py()
                yield buckets(t.slice(0, ready))
                t = t.slice(ready)
            held, rows = [t], 0
    if held:
        yield buckets(units(pa.concat_tables(held)))


def shingles_of(docs: DataFrame, units: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(hash, shingles) of ``units`` (hash, row, w0, w1): the distinct hashes of their word shingles, in order."""
    wanted = units.groupBy("row").agg(F.collect_list(F.struct("hash", "w0", "w1")).alias("units"))
    source = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, 0):
                words = Words(part.column(0))
                grams = words.windows(np.arange(max(0, words.size - SHINGLE + 1)), SHINGLE, 0).view(np.int64)
                n = pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
                own, w0, w1 = (x.to_numpy(zero_copy_only=False) for x in part.column(1).flatten().flatten())
                base = np.repeat(words.base, n)
                sets = [np.unique(grams[i:j]) for i, j in zip(base + w0, base + w1 - SHINGLE + 1)]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.record_batch(
                    [pa.array(own), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))],
                    names=["hash", "shingles"])

    return source.join(wanted, "row").select("text", "units").mapInArrow(
        run, "hash long, shingles array<long>")


def units_met(keys: DataFrame, block: int = BLOCK) -> tuple[DataFrame, list[DataFrame]]:
    """The buckets (see ``buckets_of``) of lines and windows (id, hash, bands) that share a band key with others, and the tables they are in."""
    kind = keys.schema["id"].dataType.simpleString()
    parts = []
    for part in range(BAND_PARTS):
        each = F.ceil(F.size("bands") / BAND_PARTS).cast("int")
        keyed = keys.select(F.explode(F.slice("bands", part * each + 1, each)).alias("key"), "hash", "id")
        met = keyed.repartition("key").sortWithinPartitions("key", "hash").mapInArrow(
            lambda batches: buckets_of(batches, block),
            f"key long, members array<long>, low {kind}, high {kind}, large boolean")
        # windows of one id overlap and are no repeats, so their buckets need two ids
        parts.append(stored(met.filter(F.col("large") | two_ids()), "lines-met"))
    return functools.reduce(DataFrame.unionByName, parts), parts


def two_ids() -> Column:
    return (F.col("key").bitwiseAND(1) == 0) | (F.col("low") < F.col("high"))


def centres_of(large: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, centre) of groups ``large`` (key, hash, n): the member nearest to the shingles that most members hold.

    A sample of the members tells which shingles these are; any member would do as a centre,
    but around this one fewer are left to compare.
    """
    some = large.filter(F.pmod(F.xxhash64("hash", F.lit(7)), F.greatest(
        F.lit(1), F.floor(F.col("n") / CENTRE_SAMPLE))) == 0).join(sets, "hash")
    taken = some.groupBy("key").agg(F.count("*").alias("taken"))
    middle = some.select("key", F.explode("shingles").alias("shingle")).groupBy("key", "shingle").agg(
        F.count("*").alias("held")).join(taken, "key").filter(2 * F.col("held") > F.col("taken")).groupBy(
        "key").agg(F.collect_list("shingle").alias("middle"))
    here = F.coalesce("middle", F.array().cast("array<long>"))
    apart = F.size("shingles") + F.size(here) - 2 * F.size(F.array_intersect("shingles", here))
    return large.join(sets, "hash").join(middle, "key", "left").select(
        "key", F.struct(apart.alias("apart"), "hash").alias("at")).groupBy("key").agg(
        F.min("at").alias("at")).select("key", F.col("at.hash").alias("centre"))


def split_large(large: DataFrame, sets: DataFrame, similarity: float,
                block: int = BLOCK) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Groups ``large`` (key, hash, n), a stored table which is dropped, split without comparing all pairs.

    Gives edges (u, v) to the centres, tables of groups (members) of at most ``block`` that hold every other
    similar pair, and the groups (key, hash, n) still larger after ``ROUNDS`` splits.

    Each member is compared with its group's centre alone: it differs from the centre by ``a`` shingles, those it has
    more first, then those it lacks, each in order. Members similar to the centre (alike) get an edge to it. Let x and y be
    similar, not both of them alike. Then some shingle is among those by which x differs and those by which y
    does: without one, y would differ from the centre by at most (1 - s) * |x or y| - a(x), and as |x or y| is at most
    |y or centre| + a(x), y would be alike, and x too. So they meet in the group of the first such shingle. x and y
    differ by at most ``most`` shingles, which follows from their sizes, so x has at most
    (most + a(x) - a(y)) / 2 shingles before that one, which bounds what x has to be told under, and which a(y) it can meet there.
    """
    edges, groups, own = [], [], None
    for _ in range(ROUNDS):
        if large.isEmpty():
            break
        if own is None:
            sets = own = stored(sets.join(large.select("hash").distinct(), "hash", "left_semi"), "lines-own")
        met = large.join(centres_of(large, sets), "key").select("centre", "hash").distinct()
        size, held = F.size("shingles"), F.size(F.array_intersect("shingles", "own"))
        alike = (held > 0) & (held >= similarity * (size + F.size("own") - held))
        most = F.floor((1 - similarity) / similarity * size + 1e-6).cast("int")
        differ = F.concat(F.array_except("shingles", "own"), F.array_except("own", "shingles"))
        told = stored(met.join(sets, "hash").join(
            sets.select(F.col("hash").alias("centre"), F.col("shingles").alias("own")), "centre").select(
            "centre", "hash", alike.alias("alike"), size.alias("size"), most.alias("most"),
            (size + F.size("own") - 2 * held).alias("a"), F.slice(differ, F.lit(1), most + 1).alias("differ")), "lines-told")
        edges.append(stored(told.filter(F.col("alike") & (F.col("hash") != F.col("centre"))).select(
            F.col("hash").alias("u"), F.col("centre").alias("v")), "lines-edges"))
        far = told.groupBy("centre").agg(F.max("size").alias("largest"), F.min(
            F.when(~F.col("alike"), F.col("a"))).alias("far")).filter(F.col("far").isNotNull())
        most = F.least("most", F.floor(
            (1 - similarity) / (1 + similarity) * (F.col("size") + F.col("largest")) + 1e-6).cast("int"))
        before = F.when(F.col("alike"), F.floor((F.col("most") + F.col("a") - F.col("far")) / 2).cast("int")).otherwise(
            F.col("most"))
        parts = told.join(far, "centre").withColumn("most", most).withColumn("before", before).filter(
            "before >= 0").select(
            "centre", "hash", "alike", "a", "most",
            F.posexplode(F.slice("differ", F.lit(1), F.col("before") + 1)).alias("at", "shingle")).select(
            F.xxhash64("centre", "shingle").alias("key"), "hash", "alike", "a",
            (F.col("most") + F.col("a") - 2 * F.col("at")).alias("upto"))
        bounds = parts.groupBy("key").agg(F.count("*").alias("n"), F.min("a").alias("low"), F.max("upto").alias("high"),
                                          F.min("alike").alias("near")).filter((F.col("n") > 1) & ~F.col("near"))
        parts = stored(parts.join(bounds.drop("n", "near"), "key").filter(
            (F.col("low") <= F.col("upto")) & (F.col("a") <= F.col("high"))).select("key", "hash", "alike"), "lines-parts")
        sizes = parts.groupBy("key").agg(F.count("*").alias("n"), F.min("alike").alias("near")).filter(
            (F.col("n") > 1) & ~F.col("near")).select("key", "n")
        kept = parts.select("key", "hash").join(sizes, "key")
        groups.append(stored(kept.filter(F.col("n") <= block).groupBy("key").agg(
            F.sort_array(F.collect_set("hash")).alias("members")).select("members"), "lines-groups"))
        drop_stored(large)
        large = stored(kept.filter(F.col("n") > block), "lines-large")
        for done in (told, parts):
            drop_stored(done)
    drop_stored(own)
    return edges, groups, large


def block_pairs(large: DataFrame, block: int) -> DataFrame:
    """(members) of all pairs of hash blocks of the groups ``large`` (key, hash, n)."""
    own = F.pmod(F.xxhash64("hash", F.lit(5)), F.col("blocks")).cast("int")
    pairs = (large.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("own", own)
             .select("key", "hash", F.explode(F.transform(
                 F.sequence(F.lit(0), F.col("blocks") - 1),
                 lambda o: F.struct(F.least(o, F.col("own")).alias("i"),
                                    F.greatest(o, F.col("own")).alias("j")))).alias("pair")))
    return pairs.groupBy("key", "pair").agg(F.sort_array(F.collect_set("hash")).alias("members")).select("members")


def similar_lines(docs: DataFrame, units: DataFrame, similarity: float, block: int = BLOCK,
                  id_col: str = "doc_id", text_col: str = "text",
                  met: tuple | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Edges (u, v) between lines, and between windows, of Jaccard similarity ``similarity`` or more, and their tables.

    Units are named by their hashes. Equal ones collapse to one before they meet. Lines of a bucket meet in
    one block; buckets of more lines are split around centres (``split_large``), so a task never
    holds more than about two blocks; only a spanning forest is emitted. ``met``: what ``units_met``
    gives, which is dropped; ``units`` need no bands then.
    """
    lines = units.filter(F.col("kind").isin(LINE, WINDOW))
    met, parts = units_met(lines, block) if met is None else met
    # the shingles of one occurrence of each line that met another
    wanted = met.select(F.explode("members").alias("hash")).distinct()
    one = lines.join(wanted, "hash", "left_semi").groupBy("hash").agg(
        F.min(F.struct("row", "w0", "w1")).alias("at")).select("hash", "at.*")
    sets = stored(shingles_of(docs, one, id_col, text_col), "lines-shingles")

    large = met.filter("large")
    sizes = large.groupBy("key").agg(F.sum(F.size("members")).alias("n"), F.min("low").alias("low"),
                                     F.max("high").alias("high")).filter(two_ids())
    large = stored(large.select("key", F.explode("members").alias("hash")).join(sizes.select("key", "n"), "key"),
                   "lines-large")
    near, groups, left = split_large(large, sets, similarity, block)
    # copies meet in most of their bands: equal sets of members are compared once
    same = functools.reduce(DataFrame.unionByName, [
        met.filter("not large").select("members"), *groups, block_pairs(left, block)])
    members = same.distinct().select(
        F.md5(F.array_join(F.col("members").cast("array<string>"), ",")).alias("group"),
        F.explode("members").alias("hash"))
    found = near
    for part in range(GROUP_PARTS):
        some = members.filter(F.pmod(F.xxhash64("group"), F.lit(GROUP_PARTS)) == part)
        found.append(stored(some.join(sets, "hash").select("group", "hash", "shingles").repartition("group")
                            .sortWithinPartitions("group", "hash").mapInArrow(
                                lambda batches: edges_of(batches, similarity), "u long, v long"), "lines-edges"))
    for done in (*parts, sets, *groups, left):
        drop_stored(done)
    return functools.reduce(DataFrame.unionByName, found), found


def chain_ends(seeds: DataFrame) -> DataFrame:
    """(row, w0, before, after) of the repeated ``seeds``: where one ends a chain in some text.

    Seeds of a text whose words touch make a chain, whose words they cover. ``before`` and
    ``after`` tell on which side an equal seed ends a chain in any text, so that all texts that
    share the seed give the same windows there.
    """
    here = Window.partitionBy("row").orderBy("w0")
    marked = seeds.select(
        "hash", F.coalesce(F.col("w0") - F.lag("w0").over(here) > SEED_WORDS, F.lit(True)).alias("before"),
        F.coalesce(F.lead("w0").over(here) - F.col("w0") > SEED_WORDS, F.lit(True)).alias("after"))
    ends = marked.groupBy("hash").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    return seeds.select("row", "w0", "hash").join(ends.hint("shuffle_hash"), "hash").drop("hash")


def windows_around(docs: DataFrame, ends: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The windows of ``SEED_WORDS`` words at repeated seeds and at every word next to the ends of their chains.

    Two texts that share a passage hold the same seeds in it, at most
    ``SEED_APART`` words apart. These cover it but for less than ``SEED_APART`` words at
    both ends, which the windows before the first and after the last seed cover.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    places = ends.groupBy("row").agg(F.collect_list(F.struct("w0", "before", "after")).alias("seeds"))  # of one text
    source = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(id_col).alias("id"),
                         F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, 2):
                yield pack(part, Words(part.column(2)))

    def pack(b: pa.RecordBatch, words: Words) -> pa.RecordBatch:
        marks = np.zeros(words.size + 1, dtype=np.int64)

        at, before, after = (x.to_numpy(zero_copy_only=False) for x in b.column(3).flatten().flatten())
        texts = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(3)).to_numpy())
        base, stop = words.base[texts], words.stop[texts]
        at = base + at

        def mark(first: np.ndarray, end: np.ndarray) -> None:
            marks[:] += np.bincount(first, minlength=len(marks))
            marks[:] -= np.bincount(end, minlength=len(marks))

        mark(at, at + 1)
        mark(np.maximum(at - SEED_APART + 1, base)[before], at[before])
        mark(at[after] + 1, np.minimum(at + SEED_APART, stop)[after])
        first = np.flatnonzero(np.cumsum(marks))
        text = words.text_at(first)
        fits = first + SEED_WORDS <= words.stop[text]
        first, text = first[fits], text[fits]
        after, base = first + SEED_WORDS, words.base[text]
        here = pa.array(text)
        return pa.record_batch(
            [b.column(0).take(here), b.column(1).take(here),
             *[pa.array(x) for x in (words.places[0][first], words.places[1][after - 1], first - base, after - base,
                                     words.hashes(first, after, SEED).view(np.int64))]],
            names=["row", "id", "start", "end", "w0", "w1", "hash"])

    return source.join(places, "row").select("row", "id", "text", "seeds").mapInArrow(
        run, f"row long, id {kind}, start long, end long, w0 long, w1 long, hash long")


def _run_starts(group: np.ndarray, w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
    """True where a run starts: in a new group, or more than ``GAP_WORDS`` after all before it."""
    new = np.ones(len(group), dtype=bool)
    new[1:] = group[1:] != group[:-1]
    apart = (np.cumsum(new) - 1) * (w1.max(initial=0) + GAP_WORDS + 1)
    upto = np.maximum.accumulate(w1 + apart)
    new[1:] |= (w0 + apart)[1:] > upto[:-1] + GAP_WORDS
    return new


def passages_of(batches: Iterator[pa.RecordBatch], passage_words: int) -> Iterator[pa.RecordBatch]:
    """The passages of repeated units sorted by (row, w0, w1); a run that may go on waits for the next rows."""
    def passages(t: pa.Table) -> pa.RecordBatch:
        c = {name: t.column(name).to_numpy() for name in t.column_names if name != "id"}
        new = _run_starts(c["row"], c["w0"], c["w1"])
        at, run = np.flatnonzero(new), np.cumsum(new) - 1
        told = np.zeros(0, dtype=bool)
        if len(at):
            told = (np.maximum.reduceat(c["w1"], at) - c["w0"][at] >= passage_words) | np.logical_or.reduceat(
                c["line"], at)
        order = np.lexsort((c["removed"], run))  # stable: by place in each part
        order = order[told[run[order]]]
        own = {name: x[order] for name, x in c.items()}
        at = np.flatnonzero(_run_starts(2 * run[order] + own["removed"], own["w0"], own["w1"]))

        def each(how: np.ufunc, name: str) -> np.ndarray:
            return how.reduceat(own[name], at) if len(at) else own[name]

        return pa.record_batch(
            [t.column("id").take(pa.array(order[at])).combine_chunks(), each(np.minimum, "start"),
             each(np.maximum, "end"), each(np.maximum, "w1") - own["w0"][at], each(np.minimum, "cluster"),
             each(np.maximum, "n"), own["removed"][at]],
            names=["id", "start", "end", "n_words", "cluster_id", "n_rows", "removed"])

    held: list[pa.RecordBatch] = []
    rows = wanted = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= max(wanted, 1 << 16):
            t = pa.Table.from_batches(held)
            last = int(np.flatnonzero(_run_starts(*(t.column(x).to_numpy() for x in ("row", "w0", "w1"))))[-1])
            yield passages(t.slice(0, last))
            held = t.slice(last).to_batches()
            rows -= last
            wanted = 2 * rows
    if held:
        yield passages(pa.Table.from_batches(held))


def repeated_passages(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
                      passage_words: int = PASSAGE_WORDS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Passages that repeat across documents: (id, start, end, n_words, cluster_id, n_rows, removed).

    A unit is repeated if its cluster has units of two ids or more. Runs of 30
    (``SEED_WORDS + SEED_APART - 1``) or more equal words in two ids are always
    found, wherever they start and end. Repeated
    units of a document that follow one another form a run, reported if it has
    ``passage_words`` words or more or holds a repeated line; the passages are
    its parts that are removed or not. ``removed``: false where the passage is
    made of the first units of their clusters (by id, then place), true
    elsewhere; keeping the false ones keeps one copy of everything.
    ``cluster_id`` is the smallest cluster of the passage, ``n_rows`` the largest
    number of units in one.

    Nulls: a null text has no units; rows with null ids take part, but an id
    must differ from another to count as a second document, so nulls alone
    never make a repeat. Rows repeated as a whole are one document. Empty
    tables give no rows; other columns are not read. Very long lines are one
    unit each and are compared whole.
    """
    units = stored(find_units(docs, bands_for(similarity, ROWS, recall), id_col, text_col, keys_apart=True), "units",
                   by="kind", distinct=["hash", "bands.list.element"])
    met = units_met(units.filter(F.col("kind") == KEYS))
    drop_part(units, "kind", KEYS)
    names = ["row", "id", "kind", "start", "end", "w0", "w1", "hash"]
    seeds = units.filter(F.col("kind") == SEED)
    twice = seeds.groupBy("hash").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter(
        "low < high").select("hash")
    seeds = stored(seeds.join(twice.hint("shuffle_hash"), "hash", "left_semi").select("row", "w0", "hash").repartition("row")
                   .dropDuplicates(["row", "w0"]), "units-seeds")
    drop_part(units, "kind", SEED)
    rest = units.filter(F.col("kind").isin(LINE, SENTENCE, WINDOW)).select(*names)
    edges, tables = similar_lines(docs, rest, similarity, id_col=id_col, text_col=text_col, met=met)
    rooted = stored(components(edges), "units-roots")
    for done in tables:
        drop_stored(done)
    near = stored(windows_around(docs, chain_ends(seeds), id_col, text_col).select(
        "row", "id", F.lit(SEED).alias("kind"), *names[3:]), "units-near")
    drop_stored(seeds)
    all_ = rest.unionByName(near)
    each = all_.groupBy("hash").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
    joined = stored(each.join(rooted, each.hash == rooted.node, "left").select(
        "hash", "low", "high", "n", F.col("root").alias("cluster"))
        .filter(F.col("root").isNotNull() | (F.col("low") < F.col("high"))), "units-clusters")
    several = joined.filter(F.col("cluster").isNotNull())
    clusters = several.groupBy("cluster").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).filter(
        "low < high").select("cluster", "low", "n")
    # a unit without links is a cluster of its own
    named = several.select("hash", "cluster").join(clusters, "cluster").select("hash", "cluster", "low", "n").unionByName(
        joined.filter(F.col("cluster").isNull()).select("hash", F.col("hash").alias("cluster"), "low", "n"))
    parts = []
    for some, files in ((rest, units), (near, near)):  # one after the other: only one part's shuffle is on disk at a time
        parts.append(stored(some.join(named.hint("shuffle_hash"), "hash").drop("hash"), "units-found"))
        drop_stored(files)
    found = parts[0].unionByName(parts[1])
    for done in (rooted, joined):
        drop_stored(done)
    # a cluster's first unit is in its smallest id, so only units there are compared by place
    least = F.col("id").eqNullSafe(F.col("low"))
    place = F.rank().over(Window.partitionBy("cluster").orderBy("row", "start"))
    found = found.filter(~least).withColumn("removed", F.lit(True)).unionByName(
        found.filter(least).withColumn("removed", place > 1))
    kind = docs.schema[id_col].dataType.simpleString()
    return found.select("row", "id", "start", "end", "w0", "w1", (F.col("kind") == LINE).alias("line"),
                        "removed", "cluster", "n").repartition("row").sortWithinPartitions(
        "row", "w0", "w1").mapInArrow(
        lambda batches: passages_of(batches, passage_words),
        f"id {kind}, start long, end long, n_words long, cluster_id long, n_rows long, removed boolean")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
