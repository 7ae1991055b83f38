"""Spelling variants: words one edit apart, found by two-dimensional range reporting on wavelet trees.

Two words differ by one code point inserted, deleted or replaced exactly if, for the
longer one's length L and some place p below L, they agree before p and after it. Words
of length L are points: their rank in forward order, and in reverse order. Those that
agree with a word before p are an interval of the first, those that agree after p an
interval of the second, and a wavelet tree of the points reports what lies in both; an
insertion among equal code points counts at its last place only, so that each pair is
reported once.

The points are dealt out by what must be equal whatever p is: places below L/2 by the
second half, the others by the first half, so that any two near words meet in one
group, once. A group of too many words is dealt anew by halves of the places that are
left, down to single places, where no more than one word for each letter agree. Groups
share tasks by hash; a task returns a count and the best neighbour for each word, no
pairs.

Null texts have no words; repeated rows count again; rows without doc_id hash as if
it were empty; an empty table gives an empty one; further columns are ignored. Texts and
words may be of any length; words of letters beyond U+00FF don't occur by the pattern.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT, materialize, table
from .importance import CRC_STEPS, LOWER, UPPER, crc32_sql

LETTERS, LEAST_LENGTH, LEAST_COUNT, RATIO, NOISE = "[A-Za-z\\u00C0-\\u00FF]", 6, 5, 5, 199
#: Words of a task's tree for one length, about; of a group that is not dealt anew, at least; queries that go through a tree at once.
SHARD, GROUP, AT_ONCE = 40_000, 20_000, 200_000


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n): runs of letters with A-Z lowered, from every `noise`-th of which (by the crc32 of `<doc_id>:<run>`) one code point is gone."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    # Shorter runs can't become words; a longer one is matched as a whole.
    raw = rows.select("id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))).alias("raw"))
    low = F.when(F.octet_length("raw") == F.char_length("raw"), F.lower("raw")).otherwise(F.translate("raw", UPPER, LOWER))
    runs = raw.select("id", low.alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = "int(h % char_length(run))"
    word = F.when(F.col("h") % noise == 0, F.expr(f"concat(left(run, {at}), substring(run, {at} + 2))")).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class WaveletTree:
    """Reports, for many queries at once, the points of a permutation with place in [l, r) and value in [a, b)."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), []
        for k in range(max(1, int(max(self.n - 1, 1)).bit_length()) - 1, -1, -1):
            low = (values >> k) & 1 == 0
            zeros = np.zeros(self.n + 1, np.int64)
            np.cumsum(low, out=zeros[1:])
            self.levels.append((k, zeros))
            values = np.concatenate([values[low], values[~low]])

    def report(self, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) of every point found."""
        q = np.flatnonzero((left < right) & (low < high))
        l, r, v = left[q], right[q], np.zeros(len(q), np.int64)
        for k, zeros in self.levels:
            zl, zr, nz = zeros[l], zeros[r], zeros[-1]
            a, b = low[q], high[q]
            down = (zl < zr) & (v < b) & (v + (1 << k) > a)
            up_v = v + (1 << k)
            up = (r - zr > l - zl) & (up_v < b) & (up_v + (1 << k) > a)
            l, r, v, q = (
                np.concatenate([zl[down], (nz + l - zl)[up]]), np.concatenate([zr[down], (nz + r - zr)[up]]), np.concatenate([v[down], up_v[up]]), np.concatenate([q[down], q[up]]),
            )
        return q, v


def _interval(ordered: np.ndarray, words: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray]:
    """Where words of `ordered` (fixed-width bytes) begin with the first `known` letters of each of `words` (a matrix as wide)."""
    width = ordered.dtype.itemsize
    probe = words.copy()
    probe[:, known:] = 0
    first = np.searchsorted(ordered, probe.view(f"S{width}").ravel(), "left")
    probe[:, known:] = 255
    return first, np.searchsorted(ordered, probe.view(f"S{width}").ravel(), "right")


def near_words(length: int, low: int, high: int, words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct words of `length` or one letter less: how many are one edit away at places [low, high), and the index of the best of them (-1: none).

    The best has the largest count; of those the smallest word.
    """
    sizes = np.array([len(w) for w in words])
    raw = np.array([w.encode("latin-1") for w in words], f"S{length}")
    points, short = np.flatnonzero(sizes == length), np.flatnonzero(sizes == length - 1)
    prefer = np.empty(len(words), np.int64)
    by_preference = np.lexsort((raw, -counts))
    prefer[by_preference] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    if len(points):
        points = points[np.argsort(raw[points], kind="stable")]
        forward = raw[points]
        letters = forward.view(np.uint8).reshape(len(points), length)
        backward = np.ascontiguousarray(letters[:, ::-1])
        back = backward.view(f"S{length}").ravel()
        from_back = np.argsort(back, kind="stable")
        rank = np.empty(len(points), np.int64)
        rank[from_back] = np.arange(len(points))
        tree, ordered_back = WaveletTree(rank), back[from_back]
        less = np.ascontiguousarray(raw[short].view(np.uint8).reshape(len(short), length))
        less_back = np.zeros_like(less)
        less_back[:, : length - 1] = less[:, : length - 1][:, ::-1]
        for own, asked, ahead, behind in ((True, points, letters, backward), (False, short, less, less_back)):
            for at in range(0, len(asked), AT_ONCE):
                some, there, here = asked[at : at + AT_ONCE], ahead[at : at + AT_ONCE], behind[at : at + AT_ONCE]
                for p in range(low, high):
                    l, r = _interval(forward, there, p)
                    go = np.flatnonzero(r - l > own)  # a point alone in its interval is the word itself
                    if not len(go):
                        continue
                    a, b = _interval(ordered_back, here[go], length - 1 - p)
                    q, v = tree.report(l[go], r[go], a, b)
                    found = from_back[v]
                    q = go[q]
                    differ = letters[found, p] != there[q, p] if own or p < length - 1 else np.ones(len(q), bool)
                    asker, other = some[q[differ]], points[found[differ]]
                    for x, y in ((asker, other),) if own else ((asker, other), (other, asker)):
                        near += np.bincount(x, minlength=len(words))
                        np.minimum.at(best, x, prefer[y])
    return near, np.where(best < len(words), by_preference[np.minimum(best, len(words) - 1)], -1)


KEY = ["length", "low", "high", "before", "behind"]


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (word, n, length, low, high) with what words that differ at places [low, high) of `length` share."""
    return rows.withColumn("before", F.expr("left(word, low)")).withColumn("behind", F.expr("right(word, length - high)"))


def dealt(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n, KEY): each word in the groups where it can meet near words; no group is over `group` and 1/HOT of all rows but those of one place."""
    size = F.char_length("word").cast("int")
    halves = "explode(array(named_struct('low', 0, 'high', length div 2), named_struct('low', length div 2, 'high', length)))"
    rows = words.withColumn("length", F.explode(F.array(size, size + 1))).withColumn("__half", F.expr(halves)).select("word", "n", "length", F.col("__half.low").cast("int").alias("low"), F.col("__half.high").cast("int").alias("high"))
    rows = materialize(_keyed(rows), "slots")
    limit = max(group, rows.count() // HOT)
    done = None
    while True:
        # Fewer than HOT, by the limit; groups of one place have at most a word for each letter.
        hot = materialize(rows.where("high - low > 1").groupBy(*KEY).count().where(F.col("count") > limit).select(*KEY), "hot-slots")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        cold = rows.join(F.broadcast(hot), KEY, "left_anti")
        done = cold if done is None else done.unionByName(cold)
        halved = rows.join(F.broadcast(hot), KEY, "left_semi").withColumn("__mid", F.expr("int((low + high) div 2)"))
        lower, upper = halved.withColumn("high", F.col("__mid")), halved.withColumn("low", F.col("__mid"))
        rows = materialize(_keyed(lower.unionByName(upper).select("word", "n", "length", "low", "high")), "slots")


def neighbours(words: DataFrame, group: int = GROUP, shard: int = SHARD) -> DataFrame:
    """(word, n_near, best_n, best) of the distinct words (word, n) that have any near word."""
    rows = dealt(words, group)
    tasks = 1 + rows.count() // (4 * shard)

    def run(key: tuple, held: pa.Table) -> pa.Table:
        length, low, high = (x.as_py() for x in key[:3])
        words, counts = held.column("word").to_pylist(), held.column("n").to_numpy()
        near, best = near_words(length, low, high, words, counts)
        k = np.flatnonzero(near)
        return pa.table({"word": pa.array([words[i] for i in k], pa.string()), "n_near": near[k], "best_n": counts[best[k]], "best": pa.array([words[i] for i in best[k]], pa.string())})

    parts = rows.withColumn("shard", F.pmod(F.xxhash64(*KEY), F.lit(tasks))).select("length", "low", "high", "shard", "word", "n")
    found = parts.groupBy("length", "low", "high", "shard").applyInArrow(run, "word string, n_near long, best_n long, best string")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best"))
    return merged.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last that following forms leads to. Each round doubles the steps taken."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def spelling_forms(words: DataFrame, ratio: int = RATIO, group: int = GROUP, shard: int = SHARD) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each of the distinct words (word, n)."""
    words = materialize(words.select("word", "n"), "words")
    near = neighbours(words, group, shard)
    is_form = F.col("best_n") >= ratio * F.col("n")
    known = materialize(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    return known.join(roots(known.where("form IS NOT NULL")), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(counted_words(table(spark, sf_dir, "documents")))


OP11_SQL = f"""
WITH RECURSIVE {CRC_STEPS},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
each AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS name, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, n, {crc32_sql('name')} AS h FROM each, crc),
kept AS (SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
slots AS (SELECT word, n, p, word[:p] || '_' || word[p + 2:] AS slot, word[:p] || word[p + 2:] AS short FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
inserted AS (SELECT DISTINCT s.word AS a, s.n AS a_n, w.word AS b, w.n AS b_n FROM slots s JOIN words w ON w.word = s.short),
pairs AS (
    SELECT x.word, y.word AS other, y.n AS other_n FROM slots x JOIN slots y ON x.slot = y.slot AND x.word <> y.word
    UNION ALL SELECT a, b, b_n FROM inserted UNION ALL SELECT b, a, a_n FROM inserted
),
near AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -other_n, w := other)) AS best FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * n THEN best.w END AS form, CASE WHEN -best.m >= 5 * n THEN -best.m END AS form_n FROM words LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS last, 0 AS step FROM forms UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY word) USING (word)
"""
