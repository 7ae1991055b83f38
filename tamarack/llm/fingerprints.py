"""Document fingerprints: one-permutation MinHash with optimal densification; DataFrame expressions only.

Words are what white space separates, shingles five successive words (all words of
a text that has fewer; an empty text has one shingle, the empty one). Each shingle
is hashed once to 63 bits: the high bits name one of BINS bins, and a bin keeps the
least hash that falls into it. An empty bin borrows from the full bin that comes
first in its own fixed pseudo-random order of all bins: the first few places of
that order are looked up directly, and where all of them are empty the first full
one is found by its place. The low BITS bits of each bin are packed, sixteen bins
to a long. The likeness of two fingerprints is the share of equal bins less the
share 2**-BITS that unequal bins agree by chance, over 1 less that share, at
least 0.

Each row needs the text of the next document by doc_id: rows are dealt to ranges of
doc_id whose limits are quantiles, so that no task sorts the whole table; the last
row of a range takes the first of the next one. Null texts count as empty; rows
that repeat a doc_id follow one another by text; a null doc_id comes first; a table
of one row has itself as next; an empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

BINS, BITS, WIDTH, TRIES = 256, 4, 5, 10


def _mix(x: int) -> int:
    """A fixed 64-bit scrambling of a counter."""
    x = (x + 0x9E3779B97F4A7C15) % 2**64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def draws(bins: int = BINS, tries: int = TRIES) -> list[list[int]]:
    """For each draw the bin that each bin tries then."""
    return [[_mix(b * tries + k) % bins for b in range(bins)] for k in range(tries)]


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with an array<long> column: the packed fingerprint of a text column that has no nulls."""
    low = 63 - (BINS - 1).bit_length()
    empty = (1 << low) - 1  # a hash's low part that stands for an empty bin
    tries = [F.lit(row) for row in draws()]
    marks = F.lit([b << low | empty for b in range(BINS)])
    kept = [c for c in df.columns if c != name]

    hashed = F.transform(F.array_remove(F.split(F.col(text), r"\s+"), ""), lambda w: F.xxhash64(w))
    rows = df.select(*kept, hashed.alias("__w"))
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size("__w") - (WIDTH - 1), F.lit(1))), lambda k: F.shiftrightunsigned(F.xxhash64(F.slice("__w", k, WIDTH)), 1))
    # A mark after every bin's hashes, so that the first of each bin in order is its least hash, or the mark where it is empty.
    rows = rows.select(*kept, F.sort_array(F.concat(shingles, marks)).alias("__s"))
    rows = rows.select(*kept, F.expr(f"filter(__s, (h, i) -> i = 0 or shiftright(h, {low}) != shiftright(__s[i - 1], {low}))").alias("__f"))
    rows = rows.select(*kept, F.transform("__f", lambda h: F.nullif(h.bitwiseAND(F.lit(empty)), F.lit(empty))).alias("__v"))
    full = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.col("__v")[b].isNotNull())

    def lent(i: Column) -> Column:
        """What bin i holds, its own or a full bin's, hashed with i: low bits of different values then agree independently."""
        first = F.array_min(F.transform(full, lambda c: F.shiftrightunsigned(F.xxhash64(i, c), 1).bitwiseAND(F.lit(-BINS)) + c))
        return F.xxhash64(F.coalesce(F.col("__v")[i], *[F.col("__v")[t[i]] for t in tries], F.col("__v")[first.bitwiseAND(F.lit(BINS - 1)).cast("int")]), i)

    rows = rows.select(*kept, F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: lent(i).bitwiseAND(F.lit((1 << BITS) - 1))).alias("__p"))
    each = 64 // BITS
    packed = [" | ".join(f"shiftleft(__p[{k * each + j}], {j * BITS})" for j in range(each)) for k in range(BINS // each)]
    return rows.select(*kept, F.array(*[F.expr(x) for x in packed]).alias(name))


def likeness(a: str, b: str) -> Column:
    """Bias-corrected likeness of two packed fingerprints."""
    ones = sum(1 << k for k in range(0, 64, BITS))
    ones -= 2**64 if ones >= 2**63 else 0

    def unequal(k: int) -> str:
        x = f"({a}[{k}] ^ {b}[{k}])"
        any_bit = " | ".join(f"shiftrightunsigned({x}, {j})" for j in range(BITS))
        return f"bit_count(({any_bit}) & {ones}L)"

    differ = " + ".join(unequal(k) for k in range(BINS * BITS // 64))
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (F.lit(1.0) - F.expr(differ) / F.lit(float(BINS)) - F.lit(chance)) / F.lit(1.0 - chance))


def text_of(name: str) -> Column:
    """A packed fingerprint as hexadecimal text."""
    return F.concat(*[F.lpad(F.lower(F.hex(F.col(name)[k])), 64 // 4, "0") for k in range(BINS * BITS // 64)])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    limits = sorted(set(rows.select("doc_id").approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.25 / ranges)))
    limits = F.lit([int(x) for x in limits]) if limits else F.array().cast("array<bigint>")
    at = F.size(F.filter(limits, lambda x: x < F.coalesce("doc_id", F.lit(-(2**63)))))
    rows = rows.withColumn("range", at)
    # The first doc_id of each range (as many rows as ranges): the last row of the range before it takes that document as its next.
    heads = rows.groupBy("range").agg(F.min(F.struct("doc_id")).alias("head")).orderBy("range").collect()
    after = [(heads[(k + 1) % len(heads)].head.doc_id, h["range"]) for k, h in enumerate(heads)]
    guests = spark.createDataFrame(after, "head long, into int")
    own = rows.withColumn("guest", F.lit(False))
    lent = rows.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", F.col("into").alias("range"), F.lit(True).alias("guest"))
    both = with_fingerprint(own.unionByName(lent), "text", "print")
    order = Window.partitionBy("range").orderBy("guest", "doc_id", "text")
    seen = both.select("*", F.lead("text").over(order).alias("next_text"), F.lead("print").over(order).alias("next_print")).where(~F.col("guest"))
    n = seen.withColumn("n_chars", F.length("text").cast("long"))
    edited = n.select("doc_id", "n_chars", "print", "next_print", F.expr("concat(left(text, int(n_chars - n_chars div 2)), left(next_text, int(n_chars div 2)))").alias("edited"))
    done = with_fingerprint(edited.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256)), "edited", "edited_print")
    return done.select(
        "doc_id", "n_chars", "edited_sha256", text_of("print").alias("fingerprint"), text_of("edited_print").alias("edited_fingerprint"),
        likeness("print", "edited_print").alias("near_edited"), likeness("print", "next_print").alias("near_next"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
