"""Best-fit packing with exact complements.

The packing plan needs only how many pieces there are of each length, and
there are at most ``size`` lengths. The plan is made from this table on the
driver; giving the pieces their places is a Spark job.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.llm.common import bounded_batches, gapless_rank, salts_for, stored, table
from riverwatch.llm.tokens import default_path, encoder

SIZE = 1024
END_ID = 2
Pattern = tuple[tuple[int, ...], int]  # lengths of one sequence, and how many such sequences


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first may be shorter, the others are full."""
    first = (n - 1) % size + 1
    return [(0, first), *((at, size) for at in range(first, n, size))]


def document_pieces(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE,
                    end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """A row for each piece: id, piece, start, length, ids_crc32, and ``ids`` if asked for.

    A document's ids are those of its whole text (null: empty) and ``end_id``.
    """
    path = tokenizer or default_path()
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                data = enc.ids(text or "") + end
                for k, (at, n) in enumerate(cuts(len(data) // 4, size)):
                    part = data[4 * at:4 * (at + n)]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
            columns = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                       pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names=names)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, schema + ", ids array<int>" * with_ids)


def _exact_fill(gap: int, parts: int, have: np.ndarray) -> tuple[int, ...] | None:
    """``parts`` (1 to 3) available lengths that sum to ``gap``, the largest possible first."""

    def pair(total: int, most: int) -> tuple[int, int] | None:
        # the index of pair sums at ``total``: a >= b with a + b = total, both available
        a = np.arange(min(total - 1, most), (total - 1) // 2, -1)
        ok = np.flatnonzero((have[a] > 0) & (have[total - a] > 0) & ((2 * a != total) | (have[a] > 1)))
        return (int(a[ok[0]]), int(total - a[ok[0]])) if len(ok) else None

    if parts == 1:
        return (gap,) if have[gap] else None
    if parts == 2:
        return pair(gap, gap)
    for a in np.flatnonzero(have[:max(0, gap - 1)])[::-1].tolist():
        if 3 * a < gap:
            break
        have[a] -= 1
        rest = pair(gap - a, a)
        have[a] += 1
        if rest:
            return (a, *rest)
    return None


def plan_packing(counts: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Patterns that place every piece, from the number of pieces of each length.

    The plan with the fewest sequences of several: exact complements for the
    lengths over half the size or for all, of up to three, two or one pieces.
    """
    plans = (_plan(counts, size, least, parts) for parts in (3, 2, 1) for least in (size // 2 + 1, 1))
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _plan(counts: dict[int, int], size: int, least: int, parts_most: int = 3) -> list[Pattern]:
    """The plan with complements of up to ``parts_most`` pieces for the lengths from ``least`` on.

    1. Exact complements: for each of these lengths, longest first, those over
       half the size before all others, the gap it leaves is looked up among
       single lengths, then sums of pairs, then sums of triples; a combination is taken as often as the counts allow.
    2. Best fit: what is left goes, longest first, to the open sequence with
       the smallest gap that holds it, all sequences of one kind at a time.
    A step uses up a length or a kind of open sequence, so there are a few
    thousand steps at most, whatever the number of pieces.
    """
    have = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] = n
    done: list[Pattern] = [((size,), int(have[size]))] if have[size] else []
    have[size] = 0
    half = size // 2
    turns = [(size - 1, half, parts) for parts in range(1, parts_most + 1)]
    if least <= half:
        turns += [(half, least - 1, parts) for parts in range(1, parts_most + 1)]

    def fill_for(length: int, parts: int) -> tuple[int, ...] | None:
        have[length] -= 1  # a piece is not its own complement
        fill = _exact_fill(size - length, parts, have)
        have[length] += 1
        return fill

    for most, stop, parts in turns:
        for length in range(most, stop, -1):
            while have[length] and (fill := fill_for(length, parts)):
                need = Counter((length, *fill))
                times = min(int(have[x]) // k for x, k in need.items())
                for x, k in need.items():
                    have[x] -= k * times
                done.append(((length, *fill), times))
    bins: dict[int, list[Pattern]] = defaultdict(list)
    gaps = np.zeros(size + 1, dtype=bool)

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = size - sum(lengths)
        bins[gap].append((lengths, times))
        gaps[gap] = True

    for length in range(size - 1, 0, -1):
        left = int(have[length])
        while left:
            fitting = np.flatnonzero(gaps[length:])
            if not len(fitting):
                each = size // length
                if left >= each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                break
            gap = length + int(fitting[0])
            lengths, times = bins[gap].pop()
            gaps[gap] = bool(bins[gap])
            # a sequence takes as many of this length as it holds
            each = min(gap // length, left)
            used = min(times, left // each)
            if times > used:
                bins[gap].append((lengths, times - used))
                gaps[gap] = True
            put(lengths + (length,) * each, used)
            left -= each * used
    return done + [p for kind in bins.values() for p in kind]


def places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, low, high, each, sequence, offset): where the ranks low..high-1 of a length go.

    The q-th of them goes to sequence + q // each, at offset + (q % each) * length.
    """
    used: Counter = Counter()
    out, sequence = [], 0
    for lengths, times in patterns:
        at = 0
        for length, each in sorted(Counter(lengths).items(), reverse=True):
            low = used[length]
            used[length] += each * times
            out.append((length, low, low + each * times, each, sequence, at))
            at += each * length
        sequence += times
    return out


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``size``) plus ``sequence_id`` and ``offset``.

    Every piece gets a place; no sequence holds more than ``size`` ids and its
    pieces lie one after the other from offset 0. The table of lengths and the
    table of places are bounded by ``size``, not by the data, so they may pass
    through the driver and be broadcast. Ranks within a length are found in
    salted parts, so a length that most pieces have is no bottleneck.
    """
    spark = pieces.sparkSession
    kept = stored(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in kept.groupBy("length").agg(
        F.count("*").alias("n")).collect()}  # at most ``size`` rows
    rows = places(plan_packing(counts, size))
    where = spark.createDataFrame(
        rows, "length long, __low long, __high long, __each long, __sequence long, __at long")
    ranked = gapless_rank(kept, ["length"], ["__row"], "__rank", salts_for(sum(counts.values())))
    q = F.col("__rank") - F.col("__low")
    return (ranked.join(F.broadcast(where), "length")
            .filter("__rank >= __low AND __rank < __high")
            .withColumn("sequence_id", F.col("__sequence") + F.floor(q / F.col("__each")))
            .withColumn("offset", F.col("__at") + q % F.col("__each") * F.col("length"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE,
                   end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their places.

    Nulls: a null text is empty, its piece holds ``end_id`` alone; null and
    repeated ids are carried along, each row is packed by itself. An empty
    table gives an empty result. Other columns are not read. Very long texts
    are cut into pieces of ``size`` ids after the whole text is encoded.
    """
    return pack(document_pieces(docs, tokenizer, size, end_id, with_ids), size)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences, from pieces that carry ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``size`` ids
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
