import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from llm_cases import ODD, documents, words

from tamarack.llm import importance
from tamarack.llm.importance import BucketCounter, resample

BUCKETS = 50


def features(text, least, most):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(importance.WORD, low)
    return len(found), [" ".join(found[k : k + n]) for n in range(least, most + 1) for k in range(len(found) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % BUCKETS


def plain(rows, target, least, most, percent, least_words):
    """Rows (doc_id, n_features, weight, score, rank) by loops."""
    own = [(i, *features(t, least, most)) for i, t in rows]
    s, t = Counter(bucket(f) for _, _, x in own for f in x), Counter(bucket(f) for x in target for f in features(x, least, most)[1])
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + BUCKETS) / ((s[b] + 1) * (T + BUCKETS)))) for b in range(BUCKETS)]
    out = []
    for i, n, x in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in x)
        out.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((r for r in out if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(fit[: len(fit) * percent // 100])}
    return sorted([(*r[:4], rank.get(id(r))) for r in out], key=str)


def texts_of(n):
    return [" ".join(words(k, 5 + 11 * (k % 7), 90)).replace("w1", "W1") + "." * (k % 3) for k in range(n)]


@pytest.mark.parametrize("least,most,percent", [(1, 1, 30), (1, 2, 10), (2, 3, 100)])
def test_rows_of_a_plain_loop(spark, least, most, percent):
    texts = [*texts_of(60), None, *ODD, "naïve Ünder 1x ÀÉ"]
    target = [" ".join(words(900 + k, 30, 40)) for k in range(5)] + [None]
    got = resample(documents(spark, texts), spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string"), least, most, BUCKETS, percent=percent)
    want = plain(list(enumerate(texts)), target, least, most, percent, 20)
    assert sorted([tuple(r) for r in got.collect()], key=str) == want


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 200)
    texts = ["short one", " ".join(words(3, 2000, 300)), "", "x" * 1000, "tail of three"]
    for least, most in ((1, 1), (1, 3), (3, 3)):
        counter = BucketCounter(least, most, BUCKETS)
        for text, (n, m, b, c) in zip(texts, counter.count(texts)):
            count, all_of_it = features(text, least, most)
            assert (n, m) == (count, len(all_of_it))
            assert dict(zip(b.tolist(), c.tolist())) == dict(Counter(map(bucket, all_of_it)))


def test_ranks_follow_one_order_over_all_parts(spark):
    rows = spark.range(5000).selectExpr("id", "(id * 7919) % 13 AS score")
    got = importance.ranked(rows, 1200, rows.score.desc(), rows.id.asc()).collect()
    want = {r["id"]: k + 1 for k, r in enumerate(sorted(got, key=lambda r: (-r["score"], r["id"])))}
    assert len(got) == 5000 and all(r["rank"] == (want[r["id"]] if want[r["id"]] <= 1200 else None) for r in got)


def test_odd_tables(spark):
    target = spark.createDataFrame([(1, "w1 w2 w3")], "item_id int, text string")
    text = " ".join(words(1, 30))
    df = documents(spark, [text, text, text, None], ids=[7, 7, None, None])
    got = [tuple(r) for r in resample(df, target, percent=100).collect()]
    assert sorted(r[4] or 0 for r in got) == [0, 1, 2, 3] and sum(r[0] == 7 for r in got) == 2
    assert resample(df.where("false"), target).count() == 0
    assert resample(df, target.where("false"), percent=50).where("rank IS NOT NULL").count() == 1
    clashing = df.selectExpr("*", "1 AS weight", "2 AS rank", "3 AS totals", "4 AS buckets")
    assert resample(clashing, target).columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_many_alike_rows_are_ranked(spark):
    df = spark.range(3000).selectExpr("1L AS doc_id", "repeat('w1 w2 ', 20) AS text")
    ranks = [r["rank"] for r in resample(df, df.limit(1), percent=50).collect()]
    assert sorted(x for x in ranks if x) == list(range(1, 1501))
