"""Best-fit packing of token sequences.

Large-item matching over the histogram of lengths: pieces above a third of the
capacity go at most two to a bin, each largest one with the largest partner that
still fits; smaller pieces then go, longest first, into the tightest gap. As
lengths are whole numbers up to the capacity, the whole plan is made from one
count per length (at most `capacity` rows on the driver, whatever the corpus) and
packs the corpus as one, not group by group. Pieces get their place from
their rank among those of their length; ranks come from counts by (length, salt),
so that a length which very many pieces share is dealt over all tasks.

Null texts are empty ones and give one piece (the closing id alone); repeated
rows are packed once each; equal lengths are ordered by doc_id and piece; an
empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import bisect
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_groups, materialize, table
from .token_counts import CACHE_UNITS, encoder

#: Tokens of a sequence, characters of texts whose units are looked up together.
CAPACITY, GROUP_CHARS = 2048, 4_000_000


def tokenized_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, cache_units: int = CACHE_UNITS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids with end_id after them, cut only where longer than capacity."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds)))
    step, end = 4 * capacity, struct.pack("<I", end_id)

    def as_bytes(ids: list[int]) -> bytes:
        own = array("I", ids)
        if sys.byteorder == "big":
            own.byteswap()
        return own.tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encoder(vocabulary, as_bytes, "u4", cache_units), []
        for batch in batches:
            ids, rest, piece = iter(batch.column(0).to_pylist()), b"", 0
            doc_id = next(ids, None)
            for some in in_groups((x.as_py() for x in batch.column(1)), GROUP_CHARS):
                for (last, _), part in zip(some, enc.joined([block for _, block in some])):
                    rest = b"".join((rest, part, end)) if last else rest + part
                    at, upto = 0, len(rest) if last else len(rest) - 1  # the closing id of others is still to come
                    while at + step <= upto or last and at < upto:
                        own = rest[at : at + step]
                        out.append((doc_id, piece, piece * capacity, len(own) // 4, zlib.crc32(own)))
                        at, piece = at + step, piece + 1
                    rest = rest[at:]
                    if last:
                        doc_id, rest, piece = next(ids, None), b"", 0
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema=schema)

    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def match_lengths(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many, [(length, pieces of it in each)]) for so many pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    large = sorted(n for n in left if 3 * n > capacity)
    gaps: dict[int, list] = {}
    order: list[int] = []

    def put(gap: int, many: int, holds: list) -> None:
        if gap not in gaps:
            gaps[gap] = []
            bisect.insort(order, gap)
        gaps[gap].append((many, holds))

    while large:
        n = large[-1]
        at = bisect.bisect_right(large, capacity - n) - 1
        other = large[at] if at >= 0 else None
        if other is None or other == n and left[n] < 2:
            if other == n and at > 0:
                other = large[at - 1]
            else:
                put(capacity - n, left[n], [(n, 1)])
                large.pop()
                continue
        if other == n:
            many = left[n] // 2
            put(capacity - 2 * n, many, [(n, 2)])
            left[n] -= 2 * many
        else:
            many = min(left[n], left[other])
            put(capacity - n - other, many, [(n, 1), (other, 1)])
            left[n] -= many
            left[other] -= many
            if not left[other]:
                large.remove(other)
        if not left[n]:
            large.pop()

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        at = bisect.bisect_left(order, n)
        while todo:
            if at >= len(order):
                gap, many, holds = capacity, -(-todo // (capacity // n)), []
            else:
                gap = order[at]
                many, holds = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            each = gap // n
            full = min(many, todo // each)
            todo -= full * each
            if full:
                put(gap - each * n, full, [*holds, (n, each)])
            if full < many and todo:
                put(gap - todo * n, 1, [*holds, (n, todo)])
                full, todo = full + 1, 0
            if full < many:
                put(gap, many - full, holds)
            at = bisect.bisect_left(order, n)
    return [(many, holds) for rows in gaps.values() for many, holds in rows]


def placements(bins: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, pieces a bin, first sequence_id, offset in the bin) of each run of ranks."""
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for many, holds in bins:
        offset = 0
        for n, each in holds:
            low = ranks.get(n, 0)
            ranks[n] = low + many * each
            out.append((n, low, ranks[n], each, sequence, offset))
            offset += n * each
        sequence += many
    return out


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...), which must be a stored table."""
    spark = pieces.sparkSession
    counts = {int(r.length): int(r.n) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = placements(match_lengths(counts, capacity))
    # At most a few rows for each length: bounded by the capacity, so that sending it to every task is safe.
    plan = spark.createDataFrame(places or [(0, 0, 0, 1, 0, 0)], "length long, low long, high long, each long, first long, base long")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("rn", F.row_number().over(own)).join(offsets, ["length", "salt"]).withColumn("rank", F.col("ahead") + F.col("rn") - 1)
    at = ranked.join(F.broadcast(plan.withColumnRenamed("length", "of")), (F.col("of") == F.col("length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    nth = F.col("rank") - F.col("low")
    return at.select(
        *pieces.columns,
        (F.col("first") + F.expr("(rank - low) div each")).alias("sequence_id"),
        (F.col("base") + (nth % F.col("each")) * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, cache_units: int = CACHE_UNITS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    return pack_pieces(materialize(tokenized_pieces(docs, vocabulary, capacity, cache_units=cache_units), "pieces"), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
