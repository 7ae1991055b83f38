"""Importance resampling towards a target distribution over hashed word n-grams.

Each task holds an in-memory DuckDB. A batch of texts becomes rows of words by unnest,
n-grams by window functions, and buckets by a registered zlib CRC of the distinct
n-grams; what leaves is one row of bucket counts a document, and one row of totals a
task, written to Parquet in the shared folder. Spark adds the totals of corpus and
target, of which there are as many as buckets, and every document's counts are weighed
with the gain of each bucket. Ranks come from a range partitioning and the sizes of
its parts; no row meets all others in one task.

Null texts have no words (weight 0); repeated rows each give a row and may each be
drawn; rows without doc_id count as those of the id "" and rank last among ties; an
empty corpus gives an empty table, an empty target gains from its buckets' zeros;
further columns are ignored. Texts of any length: those over PIECE characters are
counted in pieces, cut between words, each with the words before it that its first
n-grams need.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: Words once A-Z are lowered, and the same before that; characters of a query's texts at most.
WORD, RAW_WORD, PIECE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", 1 << 22
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


class BucketCounter:
    """Counts of hashed n-grams of texts, by queries of a DuckDB of its own."""

    def __init__(self, least: int, most: int, buckets: int):
        import duckdb

        self.most, self.buckets = most, buckets
        # Without a folder to spill to: what a query takes is bounded instead.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})

        def crc(grams: pa.Array) -> pa.Array:
            return pa.array([zlib.crc32(x) % buckets for x in grams.cast(pa.binary()).to_pylist()], pa.int32())

        self.db.create_function("crc_bucket", crc, ["VARCHAR"], "INTEGER", type="arrow")
        one = f"translate(word, '{UPPER}', '{LOWER}')"
        if most == 1:
            grams = f"SELECT r, word AS gram FROM placed WHERE pos > skip"
        else:
            ahead = ", ".join(f"lead(word, {k}) OVER w AS w{k}" for k in range(1, most))
            each = [" || ' ' || ".join(["word", *(f"w{k}" for k in range(1, n))]) for n in range(least, most + 1)]
            ends = [f"pos + {n - 1} > skip" for n in range(least, most + 1)]
            grams = " UNION ALL ".join(f"SELECT r, {x} AS gram FROM near WHERE {x} IS NOT NULL AND {end}" for x, end in zip(each, ends))
            grams = f"SELECT r, gram FROM ({grams})"
        near = "" if most == 1 else f", near AS (SELECT r, pos, skip, word, {ahead} FROM placed WINDOW w AS (PARTITION BY r ORDER BY pos))"
        self.sql = f"""
WITH cut AS MATERIALIZED (SELECT r, skip, regexp_extract_all(text, '{RAW_WORD}') AS words FROM given),
placed AS (SELECT r, skip, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM cut){near},
counted AS (SELECT r, gram, count(*) AS n FROM ({grams}) GROUP BY r, gram),
hashed AS (SELECT gram, crc_bucket({one.replace('word', 'gram')}) AS bucket FROM (SELECT DISTINCT gram FROM counted)),
summed AS (SELECT r, bucket, sum(n)::INTEGER AS n FROM counted JOIN hashed USING (gram) GROUP BY r, bucket),
lists AS (SELECT r, list(bucket) AS buckets, list(n) AS counts, sum(n)::BIGINT AS n_features FROM summed GROUP BY r)
SELECT c.r, len(c.words) - c.skip AS n_words, coalesce(l.n_features, 0) AS n_features, coalesce(l.buckets, []) AS buckets, coalesce(l.counts, []) AS counts
FROM cut c LEFT JOIN lists l ON l.r = c.r ORDER BY c.r
"""

    def query(self, texts: list[str], skips: list[int]) -> pa.Table:
        rows = pa.table({"r": pa.array(range(len(texts)), pa.int32()), "skip": pa.array(skips, pa.int64()), "text": pa.array(texts, pa.string())})
        self.db.register("given", rows)
        out = self.db.sql(self.sql).to_arrow_table()
        self.db.unregister("given")
        return out

    def pieces(self, text: str) -> Iterator[tuple[str, int]]:
        """Pieces of a long text, cut between words, each with as many words before it as n-grams that end in it need."""
        at, before = 0, []
        while at < len(text):
            cut = _GAP.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = cut.start() if cut else len(text)
            yield " ".join([*before, text[at:end]]), len(before)
            if self.most > 1:
                before = [*before, *re.findall(RAW_WORD, text[at:end])][-(self.most - 1) :]
            at = end

    def count(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(words, n-grams, buckets, counts) of each text, in order."""
        at = 0
        while at < len(texts):
            if len(texts[at]) > PIECE:
                sums, n = np.zeros(self.buckets, np.int64), [0, 0]
                for piece, skip in self.pieces(texts[at]):
                    (words, grams, buckets, counts), = self._rows(self.query([piece], [skip]))
                    sums[buckets] += counts
                    n = [n[0] + words, n[1] + grams]
                buckets = np.flatnonzero(sums).astype(np.int32)
                yield n[0], n[1], buckets, sums[buckets]
                at += 1
                continue
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= PIECE):
                size += len(texts[upto])
                upto += 1
            yield from self._rows(self.query(texts[at:upto], [0] * (upto - at)))
            at = upto

    @staticmethod
    def _rows(found: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        words, grams = found.column("n_words").to_pylist(), found.column("n_features").to_pylist()
        lists, counts = found.column("buckets").combine_chunks(), found.column("counts").combine_chunks()
        ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
        b, c = lists.flatten().to_numpy(zero_copy_only=False), counts.flatten().to_numpy(zero_copy_only=False)
        for k, (n, m) in enumerate(zip(words, grams)):
            yield n, m, b[ends[k] : ends[k + 1]], c[ends[k] : ends[k + 1]]


COUNTS = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>, totals boolean"


def bucket_counts(rows: DataFrame, least: int, most: int, buckets: int) -> DataFrame:
    """Of rows (doc_id, text): a row of bucket counts each, and one of totals for each task (totals true)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("totals", pa.bool_())])

    def made(ids, found, totals: bool) -> pa.RecordBatch:
        n, m, b, c = zip(*found) if found else ((), (), (), ())
        ends = pa.array(np.cumsum([0, *map(len, b)]), pa.int32())
        b, c = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (b, c))
        lists = [pa.ListArray.from_arrays(ends, pa.array(b.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(c.astype(np.int64)))]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(m, pa.int64()), *lists, pa.array([totals] * len(n), pa.bool_())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, sums = BucketCounter(least, most, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = list(counter.count(part.column(1).to_pylist()))
                for _, _, b, c in found:
                    sums[b] += c
                yield made(part.column(0).to_pylist(), found, False)
        held = np.flatnonzero(sums).astype(np.int32)
        yield made([None], [(0, int(sums.sum()), held, sums[held])], True)

    return rows.mapInArrow(run, COUNTS)


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket, from the rows of totals: floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))."""
    each = corpus.where("totals").select("buckets", "counts", F.lit(True).alias("own")).unionByName(target.where("totals").select("buckets", "counts", F.lit(False).alias("own")))
    counts = each.select("own", F.explode(F.arrays_zip("buckets", "counts")).alias("x")).groupBy(F.col("x.buckets").cast("long").alias("bucket")).agg(F.sum(F.when(F.col("own"), F.col("x.counts")).otherwise(0)).alias("s"), F.sum(F.when(F.col("own"), 0).otherwise(F.col("x.counts"))).alias("t"))
    known = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(counts, "bucket", "left").na.fill(0, ["s", "t"])
    sums = known.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    S, T, B = (float(x or 0) for x in (sums["S"], sums["T"], buckets))
    ratio = ((F.col("t") + 1).cast("double") * (S + B)) / ((F.col("s") + 1).cast("double") * (T + B))
    return known.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weighed(counted: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each document; gains: one of each bucket."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, counts = batch.column(3), batch.column(4)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gains[lists.flatten().to_numpy(zero_copy_only=False)] * counts.flatten().to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())], schema=schema)

    return counted.where("NOT totals").select("doc_id", "n_words", "n_features", "buckets", "counts").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, most: int, *order) -> DataFrame:
    """rows with `rank`: 1, 2, 3... in the given total order, null beyond `most`. Only sizes of parts reach the driver."""
    parted = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    sizes = {r["part"]: r["n"] for r in parted.groupBy(F.shiftright("__at", 33).alias("part")).agg(F.count("*").alias("n")).collect()}
    before, ahead = 0, []
    for part in range(max(sizes, default=-1) + 1):
        ahead.append(before)
        before += sizes.get(part, 0)
    place = F.element_at(F.array(*[F.lit(x) for x in ahead or [0]]), (F.shiftright("__at", 33) + 1).cast("int")) + F.expr("__at & 8589934591") + 1
    return parted.withColumn("rank", F.when(place <= most, place).cast("long")).drop("__at")


def resample(docs: DataFrame, target: DataFrame, least: int = 1, most: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row; drawn are the `percent` of those with least_words words that score highest (weight plus Gumbel noise)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(target_col), F.lit("")).alias("text"))
    counted = materialize(bucket_counts(rows, least, most, buckets), "bucket-counts")
    aims = materialize(bucket_counts(wanted, least, most, buckets), "target-counts")
    gains = np.zeros(buckets, np.int64)
    for r in bucket_gains(counted, aims, buckets).collect():  # as many rows as buckets
        gains[r["bucket"]] = r["gain"]
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = materialize(weighed(counted, gains).withColumn("score", F.col("weight") + noise).withColumn("__row", F.monotonically_increasing_id()), "scored")
    fit = scored.where(F.col("n_words") >= least_words)
    drawn = ranked(fit, fit.count() * percent // 100, F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("__row"))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def crc32_sql(value: str) -> str:
    """DuckDB SQL of the unsigned crc32 of a text's UTF-8 bytes; `crc` is a table of one row with the list `steps`."""
    octets = f"list_transform(range(octet_length(encode({value}))), lambda i: ('0x' || substr(hex(encode({value})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"


#: The table of that rule, computed.
CRC_STEPS = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS steps)"

OP12_SQL = f"""
WITH {CRC_STEPS},
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
own AS (SELECT r, unnest(words) AS word FROM docs),
aim AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')) AS word FROM benchmark),
hashed AS (SELECT word, {crc32_sql('word')} % 10000 AS bucket FROM (SELECT word FROM own UNION SELECT word FROM aim), crc),
s AS (SELECT bucket, count(*) AS s FROM own JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM aim JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM own)::DOUBLE AS S_all, (SELECT count(*) FROM aim)::DOUBLE AS T_all),
gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (S_all + 10000)) / ((coalesce(s, 0) + 1)::DOUBLE * (T_all + 10000))))::BIGINT AS gain
    FROM (SELECT range AS bucket FROM range(10000)) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums
),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM own JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
    SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[:8])::UBIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
    FROM docs LEFT JOIN weights USING (r)
),
ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS fit FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= fit * 10 // 100 THEN place END AS rank FROM scored LEFT JOIN ranks USING (r)
"""
