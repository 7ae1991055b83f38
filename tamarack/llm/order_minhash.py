"""Near-duplicate groups by Order MinHash, verified by banded alignment.

A document's k-mers are its runs of five words, each labelled by how often it has
occurred before, so that no label repeats in a document (a text of fewer words has
one k-mer, all of its words). For each of BANDS sketches the document's SAMPLE
labels of least hash are taken and kept in text order; documents with an equal
sketch are candidates. Two texts that share a part s of their k-mers in the same
order agree in a sketch with probability about s**SAMPLE, so that at 0.8 about 3 in
a million pairs agree in none. Texts of few k-mers, in which five labels cannot
agree when one differs, have further sketches of two labels and of one: each label.

Candidates are verified by a banded alignment of their words: of the labels that
both have, at positions whose difference stays within a band, the longest chain
rising in both; what the chain does not cover lies in gaps, which are aligned by
edit distance. Similarity is 1 less the edits
over the words of the longer text, and pairs of `least` or more are linked. A pair
that shares `least` of its k-mers has more than that of its words; such pairs are
all found, with the probability above, and less alike ones where they meet.

No bucket is expanded into pair rows. Equal texts are one text. In a bucket every
text is first compared with its leader, the text of least priority (a hash) in it, so
that one text leads most buckets it is in; the texts of most buckets then lie in one
component, and are done. Where texts of different components have met a leader, all of
its texts are compared with each other, in blocks of BLOCK texts of like size: two
blocks are one row, and a bound by the counts of words in BINS bins, an exact one, is
taken for all their pairs at once. Only pairs within that bound are written and
aligned; so every two texts of a bucket either lie in one component, or have been
compared, or cannot be alike. For many texts that share a leader and are all unlike,
the bound's work (under a microsecond a pair) grows with the square of their number.

Null texts count as empty, and empty texts equal one another; a null doc_id sorts
before all others; rows that repeat a doc_id are grouped by their texts under that
id; an empty table gives an empty table; further columns are ignored by
`near_groups` and kept by `drop_near_copies`.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import likely, materialize, nested, one_each, sweep, table, with_groups
from .components import components, priority
from .wordhash import OF_WORDS, Words, mix, parts, prefixes, spans

KMER, LEAST_ALIKE, SAMPLE, BANDS = 5, 0.8, 5, 32
#: Texts of at most so many labels have SHORT_BANDS more sketches of two labels, and each label as one.
SHORT, SHORT_BANDS = 24, 16
#: Texts of a block, and bins in which words are counted to tell pairs that cannot be alike.
BLOCK, BINS = 256, 1024
NO_ID = -(2**63)


def labels_of(hashes: np.ndarray) -> np.ndarray:
    """The occurrence-labelled k-mers of one document's word hashes, in text order."""
    if len(hashes) < KMER:
        starts, ends = np.zeros(1, np.int64), np.array([len(hashes)])
    else:
        starts = np.arange(len(hashes) - KMER + 1)
        ends = starts + KMER
    sums, down = prefixes(hashes, OF_WORDS)
    kmers = spans(sums, down, starts, ends)
    order = np.argsort(kmers, kind="stable")
    sorted_ = kmers[order]
    new = np.ones(len(kmers), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    if new.all():
        return kmers
    at = np.flatnonzero(new)
    times = np.empty(len(kmers), np.uint64)
    times[order] = np.arange(len(kmers)) - np.repeat(at, np.diff(np.append(at, len(kmers))))
    return mix(kmers + times * np.uint64(0x632BE59BD9B4E019)) * (times > 0) + kmers * (times == 0)


def _seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


SEEDS, SHORT_SEEDS = _seeds(BANDS, 1), _seeds(SHORT_BANDS, 2)


def sketch(labels: np.ndarray, seeds: np.ndarray, sample: int) -> np.ndarray:
    """One key a seed: the hash of the labels of least hash in text order."""
    out = []
    step = max(1, 2_000_000 // len(labels))
    for at in range(0, len(seeds), step):
        some = seeds[at : at + step]
        if sample < len(labels):
            hashed = labels[None, :] * some[:, None]
            least = np.sort(np.argpartition(hashed, sample - 1, axis=1)[:, :sample], axis=1)
        else:
            least = np.tile(np.arange(len(labels)), (len(some), 1))
        key = some.copy()
        for k in range(least.shape[1]):
            key = mix(key * np.uint64(0x100000001B3) + labels[least[:, k]])
        out.append(key)
    return np.concatenate(out)


def band_keys(labels: np.ndarray) -> np.ndarray:
    keys = [sketch(labels, SEEDS, SAMPLE)]
    if len(labels) <= SHORT:
        keys += [sketch(labels, SHORT_SEEDS, 2), mix(labels ^ np.uint64(0xD6E8FEB86659FD93))]
    return np.concatenate(keys)


def edits(a: list[int], b: list[int], most: int) -> int:
    """Edit distance of two runs of words, or more than `most` where it is; a column of the table is one bit-parallel step."""
    if not a or not b or abs(len(a) - len(b)) > most:
        return max(len(a), len(b))
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    whole, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, found = whole, 0, len(a)
    for left, y in zip(range(len(b) - 1, -1, -1), b):
        same = places.get(y, 0)
        cross = ((same & up) + up ^ up) | same
        rise, fall = down | whole & ~(cross | up), up & cross
        found += bool(rise & last) - bool(fall & last)
        if found - left > most:
            return max(len(a), len(b))
        rise, fall = (rise << 1 | 1) & whole, fall << 1 & whole
        same |= down
        up, down = fall | whole & ~(same | rise), rise & same
    return found


def unlike(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the edit distance: words of either side, by BINS of their hashes, that the other has no partner for."""
    more = np.bincount(a & np.uint64(BINS - 1), minlength=BINS) - np.bincount(b & np.uint64(BINS - 1), minlength=BINS)
    return int(max(more[more > 0].sum(), -more[more < 0].sum()))


def aligned(a: np.ndarray, b: np.ndarray, least: float, kmers_a: np.ndarray | None = None, kmers_b: np.ndarray | None = None) -> float:
    """Similarity of two documents' words by banded alignment; 0 where their lengths forbid `least`."""
    small, large = sorted((len(a), len(b)))
    if small < least * large:
        return 0.0
    if large == 0:
        return 1.0
    if unlike(a, b) > (1 - least) * large + 1e-9:
        return 0.0
    x, y = (labels_of(a) if kmers_a is None else kmers_a), (labels_of(b) if kmers_b is None else kmers_b)
    _, at_a, at_b = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    # As many words as `least` lets differ are also how far an alignment can shift.
    near = np.abs(at_a - at_b) <= (1 - least) * large + 1
    at_a, at_b = at_a[near], at_b[near]
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    # The longest chain: of each length the end of least place, and from which pair it was reached.
    tails: list[int] = []
    ends: list[int] = []
    came = np.full(len(at_b), -1)
    for k, place in enumerate(at_b.tolist()):
        n = bisect_left(tails, place)
        came[k] = ends[n - 1] if n else -1
        if n == len(tails):
            tails.append(place)
            ends.append(k)
        else:
            tails[n], ends[n] = place, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(k)
        k = came[k]
    chain.reverse()
    width = min(KMER, len(a), len(b))
    most = (1 - least) * large + 1e-9
    cost, from_a, from_b = 0, 0, 0
    # Only where the diagonal changes or words lie between does anything cost; successive pairs on one diagonal are one run.
    i, j = at_a[chain], at_b[chain]
    breaks = np.flatnonzero((np.diff(i) > width) | (np.diff(i) != np.diff(j))) + 1
    firsts, lasts = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(chain)]]) - 1
    for f, m in zip(firsts.tolist(), lasts.tolist()) if len(chain) else ():
        # Words that two runs on different diagonals both cover belong to the first.
        over = max(0, from_a - int(i[f]), from_b - int(j[f]))
        if over >= int(i[m] - i[f]) + width:
            continue
        start_a, start_b = int(i[f]) + over, int(j[f]) + over
        cost += edits(a[from_a:start_a].tolist(), b[from_b:start_b].tolist(), int(most) - cost)
        if cost > most:
            return 0.0
        from_a, from_b = int(i[m]) + width, int(j[m]) + width
    cost += edits(a[from_a:].tolist(), b[from_b:].tolist(), int(most) - cost)
    return 1 - cost / large


def each_words(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    """The word hashes of each text of a batch."""
    for low, high, data, offsets in parts(batch, column):
        words = Words(data, offsets)
        for k in range(high - low):
            yield words.hashes[words.limits[k] : words.limits[k + 1]]


def sketched(docs: DataFrame) -> DataFrame:
    """(id, text_key, size, keys) of docs (id, text_key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for words in each_words(batch, 2):
                labels = labels_of(words)
                sizes.append(len(words))
                keys.append(band_keys(labels).view(np.int64))
            if not sizes:
                continue
            ends = np.cumsum([0, *map(len, keys)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))], names=["id", "text_key", "size", "keys"])

    return docs.select("id", "text_key", "text").mapInArrow(run, "id long, text_key binary, size int, keys array<long>")


def word_table(docs: DataFrame) -> DataFrame:
    """(id, words) of docs (id, text): the hashes of its words as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.tobytes() for x in each_words(batch, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["id", "words"])

    return docs.select("id", "text").mapInArrow(run, "id long, words binary")


def with_words(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """pairs (u, v, ...) with the words of both, those of one v one after the other; where very many pairs share v, Spark splits its partition and copies its words."""
    own, theirs = (words.select(F.col("id").alias(c), F.col("words").alias(w)).hint("merge") for c, w in (("u", "own"), ("v", "theirs")))
    return pairs.join(own, "u").join(theirs, "v")


def verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose texts are alike."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, theirs, kmers = None, None, None
        for batch in batches:
            keep = []
            for v, a, b in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if v != last:
                    last, theirs = v, np.frombuffer(b.as_py(), np.uint64)
                    kmers = labels_of(theirs)
                keep.append(aligned(np.frombuffer(a.as_buffer(), np.uint64), theirs, least, kmers_b=kmers) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(keep, pa.bool_()))

    return with_words(pairs, words).select("u", "v", "own", "theirs").mapInArrow(run, "u long, v long")


def binned(words: DataFrame) -> DataFrame:
    """(id, bins) of a table (id, words): how many words fall in each bin, 255 at most, a byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (np.bincount((np.frombuffer(x.as_buffer(), np.uint64) & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS) for x in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.minimum(c, 255).astype(np.uint8).tobytes() for c in counts], pa.binary())], names=["id", "bins"])

    return words.select("id", "words").mapInArrow(run, "id long, bins binary")


def in_bound(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which rows of a and b (counts in bins) may be within `most` (a row for each of a) edits; see `unlike`."""
    size_a, size_b = (x.sum(1, dtype=np.int64) for x in (a, b))
    out = np.empty((len(a), len(b)), bool)
    for k in range(len(a)):
        either = np.maximum(a[k], b).sum(1, dtype=np.int64)
        out[k] = either - np.minimum(size_a[k], size_b) <= most[k]
    return out


def may_be_alike(met: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """Pairs (u, v), u < v, of different roots among the texts that share a leader, whose counts of words allow `least`; met: leader, id, size, root."""
    # Texts alike lie in one class of sizes or in neighbouring ones.
    sized = met.withColumn("kind", F.floor(F.log(F.greatest(F.col("size"), F.lit(1))) / (1.001 * float(np.log(1 / least)))).cast("int"))
    many = sized.groupBy("leader", "kind").agg(F.count(F.lit(1)).alias("n"))
    dealt = sized.join(many, ["leader", "kind"]).withColumn("number", F.pmod(F.xxhash64("id"), F.expr(f"n div {BLOCK} + 1")))
    # A text has no more leaders than sketches. Two texts that share several are told by the least of these.
    own = met.groupBy("id").agg(F.collect_set("leader").alias("leaders"))
    held = dealt.join(binned(words.join(own, "id", "left_semi")).hint("merge"), "id").join(own, "id")
    blocks = held.groupBy("leader", "kind", "number").agg(F.collect_list(F.struct("id", "size", "root", "bins", "leaders")).alias("texts"))
    blocks = materialize(blocks, "blocks")
    one, other = (blocks.select("leader", F.col("kind").alias(f"kind{k}"), F.col("number").alias(f"number{k}"), F.col("texts").alias(f"texts{k}")) for k in "12")
    meet = one.join(other.hint("merge"), "leader").where("kind2 = kind1 and number2 >= number1 or kind2 = kind1 + 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leader, same, *pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                (ids, sizes, roots, bins), (ids_2, sizes_2, roots_2, bins_2) = (
                    (*(x.values.field(c).to_numpy() for c in ("id", "size", "root")), np.frombuffer(b"".join(x.values.field("bins").to_pylist()), np.uint8).reshape(-1, BINS)) for x in pair
                )
                led, led_2 = (list(map(set, x.values.field("leaders").to_pylist())) for x in pair)
                large = np.maximum(sizes[:, None], sizes_2)
                may = (np.minimum(sizes[:, None], sizes_2) >= least * large) & (roots[:, None] != roots_2)
                if same:
                    may &= ids[:, None] < ids_2
                at = np.flatnonzero(may.any(1))
                may[at] &= in_bound(bins[at], bins_2, (1 - least) * large[at] + 1e-9)
                i, j = np.nonzero(may)
                here = [min(led[m] & led_2[n]) == leader for m, n in zip(i.tolist(), j.tolist())]
                i, j = i[here], j[here]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids_2[j])), pa.array(np.maximum(ids[i], ids_2[j]))], names=["u", "v"])

    same = (F.col("kind1") == F.col("kind2")) & (F.col("number1") == F.col("number2"))
    return meet.select("leader", same.alias("same"), "texts1", "texts2").mapInArrow(run, "u long, v long")


def links_of(texts: DataFrame, words_of, least: float) -> DataFrame:
    """(node, root) of texts that are linked to any; texts: id, size (words), keys; words_of: a table of ids -> (id, words)."""
    spark = texts.sparkSession
    rows = texts.select("id", "size", F.explode("keys").alias("key"))
    first = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(priority("id").alias("p"), "size")).alias("l")).where("n > 1")
    leaders = materialize(first.select("key", F.col("l.p.node").alias("v"), F.col("l.size").alias("leader_size")), "leaders")
    met = rows.join(leaders.hint("merge"), "key").where("id != v").select(F.col("id").alias("u"), "v", "size", "leader_size")
    met = materialize(met.distinct(), "met")
    sweep(spark)
    needed = met.select(F.col("u").alias("id")).unionByName(met.select(F.col("v").alias("id"))).distinct()
    words = materialize(words_of(needed), "words")
    fit = met.where(F.least("size", "leader_size") >= least * F.greatest("size", "leader_size")).select("u", "v")
    links = materialize(verified(fit, words, least), "links")
    found = materialize(components(links), "components")
    sweep(spark)

    def placed(some: DataFrame, node: str) -> DataFrame:
        """some with the root of a node."""
        return some.join(found.select(F.col("node").alias(node), "root"), node, "left").withColumn("root", F.coalesce("root", node))

    # Leaders that texts of more than one component have met, their own included.
    met = materialize(placed(met.select(F.col("v").alias("leader"), F.col("u").alias("id"), "size"), "id"), "met-placed")
    roots = met.groupBy("leader").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = placed(roots, "leader").where("least(low, root) < greatest(high, root)").select("leader")
    again = materialize(met.join(mixed, "leader", "left_semi"), "met-again")
    if again.isEmpty():
        return found
    pairs = materialize(may_be_alike(again, words, least), "pairs")
    sweep(spark)
    more = materialize(verified(pairs, words, least), "links")
    if more.isEmpty():
        return found
    return materialize(components(more.unionByName(found.select(F.col("node").alias("u"), F.col("root").alias("v")))), "components")


def near_groups(docs: DataFrame, least: float = LEAST_ALIKE) -> DataFrame:
    """(doc_id, class_id, class_size, kept, text_key) of each row: the class is named by its least doc_id, whose row is kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.substring(F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)), 1, 16).alias("text_key"), text.alias("text"))
    sketches = materialize(sketched(own), "sketches")
    # Equal texts are one: a row for each, under a name of its own.
    each = sketches.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"), F.any_value("size").alias("size"), F.any_value("keys").alias("keys"))
    texts = materialize(each.withColumn("name", F.monotonically_increasing_id()), "texts")

    def words_of(names: DataFrame) -> DataFrame:
        wanted = texts.select("name", "id", "text_key").join(names.withColumnRenamed("id", "name"), "name")
        wanted = materialize(wanted, "wanted")
        some = likely(own, wanted, ["id", "text_key"])
        return word_table(one_each(some.join(wanted.hint("merge"), ["id", "text_key"]), ["id", "text_key"]).select(F.col("name").alias("id"), "text"))

    roots = links_of(texts.select(F.col("name").alias("id"), "size", "keys"), words_of, least)
    of_text = texts.select("name", "id", "text_key", "n").join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    of_text = materialize(of_text, "text-classes")
    classes = of_text.groupBy("root").agg(F.sum("n").alias("class_size"), F.min(F.struct("id", "text_key")).alias("least"))
    classed = of_text.join(classes, "root").select("text_key", "n", "class_size", F.col("least.id").alias("class_id"), F.col("least.text_key").alias("class_key"))
    out = with_groups(sketches.select("id", "text_key"), materialize(classed, "classed"), ["text_key"], sketches.count())
    kept = (F.col("id") == F.col("class_id")) & (F.col("text_key") == F.col("class_key"))
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(back("id").alias("doc_id"), back("class_id").alias("class_id"), "class_size", kept.alias("kept"), F.lower(F.hex("text_key")).alias("text_key"))


def drop_near_copies(docs: DataFrame, least: float = LEAST_ALIKE) -> DataFrame:
    """One row of each class, with all columns of docs."""
    kept = near_groups(docs, least).where("kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.unhex("text_key").alias("key")).distinct()
    key = F.substring(F.unhex(F.sha2(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"), 256)), 1, 16)
    own = nested(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), key.alias("key"))
    return one_each(own.join(kept, ["id", "key"], "left_semi"), ["id", "key"]).select("row.*")


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).drop("text_key")
