"""Near-duplicate clips: joins by time, resolution in runs of conflicting pairs, far ones in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vector
from ..sources.shared import stored
from .graph import chase


def band_pairs(rows: DataFrame, keys: list[str], id_col: str, time: str, hash_col: str, gap: float = 60, most: int = 8) -> DataFrame:
    """Pairs (keys, id_a, id_b, distance) a < b of rows at most `gap` apart in time and `most` bits apart.

    A row is joined only with those of its own and the next time bucket, so that the work follows the band, not all pairs.
    """
    bucket = F.floor(F.col(time) / gap).cast("long")
    left = rows.select(*keys, F.col(id_col).alias("id_a"), F.col(time).alias("__ta"), F.col(hash_col).alias("__ha"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("__b"))
    right = rows.select(*keys, F.col(id_col).alias("id_b"), F.col(time).alias("__tb"), F.col(hash_col).alias("__hb"), bucket.alias("__b"))
    near = left.join(right, [*keys, "__b"]).where((F.col("id_a") < F.col("id_b")) & (F.abs(F.col("__ta") - F.col("__tb")) <= gap))
    return near.withColumn("distance", vector.hamming(F.col("__ha"), F.col("__hb"))).where(F.col("distance") <= most).select(*keys, "id_a", "id_b", "distance")


def mean_distance(a: Column, b: Column) -> Column:
    """Mean Hamming distance of two arrays of hashes over as many as both have."""
    bits = F.zip_with(F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))), vector.hamming)
    return F.aggregate(bits, F.lit(0).cast("double"), lambda s, x: s + x) / F.greatest(F.lit(1), F.least(F.size(a), F.size(b)))


def close_pairs(rows: DataFrame, keys: list[str], place: str, start: str, end: str, cols: list[str], gap: float = 60.0) -> DataFrame:
    """Pairs of rows i < j (by `place`, which follows start) at most `gap` apart, for gaps of 0 or more: keys, i, j, apart, meet and each of cols as a_ and b_.

    A start is met in its own bucket of time only. Rows whose times are not all known are close to none.
    """
    known = rows.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    bucket = lambda c: F.floor(c / max(gap, 60.0)).cast("long")
    side = lambda p, n: [F.col(place).alias(n), F.col(start).alias(f"__{p}s"), F.col(end).alias(f"__{p}e"), *[F.col(c).alias(f"{p}_{c}") for c in cols]]
    left = known.select(*keys, *side("a", "i"), F.explode(F.sequence(bucket(F.col(start)), bucket(F.greatest(start, end) + gap))).alias("__b"))
    right = known.select(*keys, *side("b", "j"), bucket(F.col(start)).alias("__b"))
    times = [F.col(c) for c in ("__as", "__ae", "__bs", "__be")]
    met = left.join(right, [*keys, "__b"]).where("i < j").withColumn("apart", vector.time_gap(*times)).where(F.col("apart") <= gap)
    return met.withColumn("meet", vector.overlaps(*times)).drop("__b", "__as", "__ae", "__bs", "__be")


#: Rows of a source that meet in one block; rows of it compared at once; pairs of small blocks compared at once.
BLOCK, STRIP, PAIRS = 4096, 256, 1 << 18
#: Stands for no pair: later than all.
NEVER = (1 << 63) - 1
ROW = "struct<place: bigint, s: double, e: double, d: double, li: bigint, lj: bigint, h: array<bigint>>"


class Clips:
    """Rows of blocks as arrays: times and lengths with NaN for unknown ones, hashes side by side with their number and the index of the first null."""

    def __init__(self, rows: pa.StructArray):
        col = dict(zip((f.name for f in rows.type), rows.flatten()))
        self.place = col["place"].to_numpy(zero_copy_only=False)
        self.s, self.e, self.d = (col[n].fill_null(float("nan")).to_numpy(zero_copy_only=False) for n in "sed")
        self.li, self.lj = (col[n].fill_null(NEVER).to_numpy(zero_copy_only=False) for n in ("li", "lj"))
        flat, self.size = col["h"].flatten(), col["h"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.repeat(np.arange(len(self.size)), self.size), np.arange(len(flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.hashes = np.zeros((len(self.size), int(self.size.max(initial=0))), np.uint64)  # of signed ones numpy would count the bits of the absolute value
        self.hashes[at] = flat.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        self.whole = self.size.copy()
        if flat.null_count:
            null = flat.is_null().to_numpy(zero_copy_only=False)
            np.minimum.at(self.whole, at[0][null], at[1][null])

    def of(self, which) -> Clips:
        out = object.__new__(Clips)
        out.__dict__ = {k: v[which] for k, v in self.__dict__.items()}
        return out


def meet_alike(a: Clips, b: Clips, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of a and b that may be `most` bits apart in the mean or less, over as many hashes as both have."""
    size = np.minimum(a.size[:, None], b.size[None, :])
    total, least = np.zeros(size.shape, np.int32), int(size.min())
    for k in range(int(size.max())):
        bits = np.bitwise_count(a.hashes[:, k, None] ^ b.hashes[None, :, k])
        total += bits if k < least else np.where(size > k, bits, 0)
    return np.nonzero(total <= most * size + 1e-6)


def far_alike(a: Clips, b: Clips, gap: float, most: float, tolerance: float) -> np.ndarray:
    """Whether row n of a, which has not lost, and row n of b look alike, are far apart and b had not lost when they were looked at; hashes that are null look like none."""
    n, total = np.minimum(a.size, b.size), np.zeros(len(a.size), np.int64)
    for k in range(int(n.max(initial=0))):
        total += np.where(n > k, np.bitwise_count(a.hashes[:, k] ^ b.hashes[:, k]), 0)
    with np.errstate(invalid="ignore"):
        alike = (total / np.maximum(n, 1) <= most) & (n > 0) & (n <= a.whole) & (n <= b.whole)
        fits = np.abs(a.d - b.d) / np.fmax(np.fmax(a.d, b.d), 1e-6) <= tolerance
        near = (np.maximum(0.0, np.maximum(b.s - a.e, a.s - b.e)) <= gap) | ((a.e > b.s) & (b.e > a.s))
    i, j = np.minimum(a.place, b.place), np.maximum(a.place, b.place)
    return alike & fits & ~near & (i < j) & ((b.li > i) | ((b.li == i) & (b.lj > j)))


def flags(a: Clips, b: Clips, *limits: float) -> np.ndarray:
    """Which rows of a look like a far one of b, strip by strip; a row is compared until one is found."""
    found = np.zeros(len(a.place), bool)
    for low in range(0, len(a.place), STRIP):
        for at in range(0, len(b.place), STRIP):
            left = low + np.flatnonzero(~found[low : low + STRIP])
            if not len(left):
                break
            mine, theirs = a.of(left), b.of(slice(at, at + STRIP))
            x, y = meet_alike(mine, theirs, limits[1])
            found[left[x[far_alike(mine.of(x), theirs.of(y), *limits)]]] = True
    return found


def flags_of_small(a: pa.ListArray, b: pa.ListArray, *limits: float) -> tuple[np.ndarray, np.ndarray]:
    """The same for each row's own two small blocks, over all their pairs at once: the row, and the place that is found."""
    m, n = (x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b))
    mine, theirs, row = Clips(a.flatten()), Clips(b.flatten()), np.repeat(np.arange(len(m)), m)
    each = n[row]
    x = np.repeat(np.arange(len(row)), each)
    y = np.arange(len(x)) + np.repeat((np.cumsum(n) - n)[row] - (np.cumsum(each) - each), each)
    found = np.unique(x[far_alike(mine.of(x), theirs.of(y), *limits)])
    return row[found], mine.place[found]


def flagged(rows: DataFrame, lost: DataFrame, gap: float, most: float, tolerance: float, block: int = BLOCK) -> DataFrame:
    """(source, place) of the rows that have not lost and look like a far one which had not lost at the time.

    rows: source, place, clip_start, clip_end, duration, frame_hashes; lost: source, lost, i, j. The rows of a source lie in
    blocks, and each block of those that stay meets each block of all: in memory are two blocks, and no pair is a row.
    """
    c = F.col
    gone = lost.select("source", c("lost").alias("place"), c("i").alias("li"), c("j").alias("lj"))
    known = rows.where(F.size("frame_hashes") > 0).join(gone, ["source", "place"], "left")
    own = F.floor((c("place") - 1) / block).cast("long")
    large = rows.groupBy(c("source").alias("__s")).agg(F.max("place").alias("__n")).where(c("__n") > block).select("__s", (F.ceil(c("__n") / block) - 1).cast("long").alias("__last"))
    one = F.struct("place", c("clip_start").cast("double").alias("s"), c("clip_end").cast("double").alias("e"), c("duration").cast("double").alias("d"), "li", "lj", c("frame_hashes").alias("h")).cast(ROW)
    packed = lambda r: r.groupBy("source", own.alias("__block")).agg(F.collect_list(one).alias("rows"))
    theirs = stored(packed(known), "blocks").withColumnsRenamed({"source": "__s", "rows": "theirs", "__block": "__other"})
    mine = packed(known.where("li IS NULL")).join(F.broadcast(large), c("source") == c("__s"), "left")
    mine = mine.select("source", c("rows").alias("mine"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__last", F.lit(0).cast("long")))).alias("__at"))
    pairs = mine.join(theirs, (c("source") == c("__s")) & (c("__at") == c("__other"))).select("source", "mine", "theirs")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, a, b = (batch.column(n) for n in range(3))
            size = np.multiply(*(x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b)))
            small = np.flatnonzero((size <= STRIP) & (size > 1))  # of one row and itself nothing can be far
            for part in np.split(small, np.flatnonzero(np.diff(np.cumsum(size[small]) // PAIRS)) + 1) if len(small) else ():
                row, place = flags_of_small(a.take(pa.array(part)), b.take(pa.array(part)), gap, most, tolerance)
                yield pa.RecordBatch.from_arrays([sources.take(pa.array(part[row])), pa.array(place)], names=["source", "place"])
            for k in np.flatnonzero(size > STRIP).tolist():
                mine = Clips(a[k].values)
                place = mine.place[flags(mine, Clips(b[k].values), gap, most, tolerance)]
                yield pa.RecordBatch.from_arrays([sources.take(pa.array([k] * len(place), pa.int64())), pa.array(place)], names=["source", "place"])

    return pairs.mapInArrow(found, "source string, place long").distinct()


def conflict_runs(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """pairs (keys, i, j) with `run`: stretches of places that no pair reaches out of, found by a sweep over the pairs' first places."""
    w = Window.partitionBy(*keys).orderBy("i", "j")
    reach = F.max("j").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return pairs.withColumn("__new", F.coalesce((F.col("i") > reach).cast("long"), F.lit(1))).withColumn("run", F.sum("__new").over(w)).drop("__new")


def losses(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lost, to, i, j) of pairs (keys, i, j, loser, winner) taken in order of i and j: one of which either has lost before is left out.

    Only pairs of one conflict run depend on each other: a task takes the runs that it has one after the other, and holds who has lost in one.
    """
    named = [*keys, "run", "i", "j", "loser", "winner"]
    schema = pairs.select(*keys, F.col("loser").alias("lost"), F.col("winner").alias("to"), "i", "j").schema

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, gone = None, set()
        for batch in batches:
            col, take = dict(zip(named, batch.columns)), []
            for n, (*here, i, j, loser) in enumerate(zip(*(col[k].to_pylist() for k in named[:-1]))):
                if here != run:
                    run, gone = here, set()
                if i not in gone and j not in gone:
                    gone.add(loser)
                    take.append(n)
            kept = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([col[k].take(kept) for k in (*keys, "loser", "winner", "i", "j")], names=schema.names)

    runs = conflict_runs(pairs, keys).select(*named).repartition(*keys, "run").sortWithinPartitions(*keys, "run", "i", "j")
    return runs.mapInArrow(settled, schema)


STATUS = "source string, clip_id string, status string, duplicate_of string, confidence double, reason string"


def resolve(clips: DataFrame, gap: float = 60.0, most: float = 8.0, tolerance: float = 0.25) -> DataFrame:
    """(source, clip_id, status, duplicate_of, confidence, reason) of clips (source, clip_id, frame_hashes, clip_start, clip_end, duration).

    Clips are taken in order of clip_start: a removed clip is compared no more, overlapping ones lose the shorter, ones that
    look alike within the gap lose the shorter (the later of equals), and ones further apart, or whose times are not all
    known, are flagged and kept. Pairs that overlap or are near come from a join by time; what depends on earlier decisions
    is settled in runs of conflicting pairs, and a removed clip's kept one by following duplicates; who looks like a far one
    is then asked of those that stay, in blocks. Clips without hashes look like none.
    """
    key = ["source"]
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.asc_nulls_last("clip_start"), "clip_id"))
    rows = stored(clips.select("source", "clip_id", "frame_hashes", "clip_start", "clip_end", "duration").withColumn("place", place), "clips")
    c = F.col
    fits = F.abs(c("a_duration") - c("b_duration")) / F.greatest("a_duration", "b_duration", F.lit(1e-6)) <= tolerance
    hashed = (F.size("a_frame_hashes") > 0) & (F.size("b_frame_hashes") > 0)
    close = close_pairs(rows, key, "place", "clip_start", "clip_end", ["duration", "frame_hashes"], gap)
    mean = F.when(~c("meet") & hashed & fits, mean_distance(c("a_frame_hashes"), c("b_frame_hashes")))
    conflicts = close.withColumn("mean", mean).where(c("meet") | (c("mean") <= most))
    shorter = lambda a, b: F.when(c("a_duration") < c("b_duration"), c(a)).otherwise(c(b))
    conflicts = stored(conflicts.select(*key, "i", "j", "mean", shorter("i", "j").alias("loser"), shorter("j", "i").alias("winner")), "conflicts")
    lost = stored(losses(conflicts, key).join(conflicts.select(*key, "i", "j", "mean"), [*key, "i", "j"]), "losses")
    # A pair that is far apart flags both if neither had lost when it was looked at, which was at (i, j).
    flag = flagged(rows, lost, gap, most, tolerance).withColumn("flag", F.lit(True))

    ends = chase(lost.select(F.struct("source", F.col("lost").alias("place")).alias("node"), F.struct("source", F.col("to").alias("place")).alias("to")))
    kept = ends.select(F.col("node.source").alias("source"), F.col("node.place").alias("place"), F.col("last.place").alias("__kept"))
    of_lost = lost.select(*key, F.col("lost").alias("place"), "mean", F.lit(True).alias("gone")).join(kept, [*key, "place"])
    names = rows.select(*key, F.col("place").alias("__kept"), F.col("clip_id").alias("duplicate_of"))
    told = rows.select(*key, "place", "clip_id").join(of_lost, [*key, "place"], "left").join(flag, [*key, "place"], "left").join(names, [*key, "__kept"], "left")
    status = F.when(F.col("gone"), "removed").when(F.col("flag"), "flagged").otherwise("kept")
    sure = F.when(F.col("gone"), F.coalesce(F.bround(1 - F.col("mean") / 64, 3), F.lit(1.0)))
    why = F.when(F.col("gone"), F.when(F.col("mean").isNull(), "time-overlap").otherwise("near-identical-frames"))
    return told.select("source", "clip_id", status.alias("status"), "duplicate_of", sure.alias("confidence"), why.alias("reason"))
