import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD, documents

from tamarack.llm.spelling import WaveletTree, counted_words, dealt, near_words, roots, spelling_forms


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:p] + b[p + 1 :] == a for p in range(len(b)))


def plain(counts, ratio=5):
    """(word, n, n_near, form, form_n, root) of each word by all pairs."""
    form, out = {}, []
    for w, n in counts.items():
        near = sorted(((-counts[x], x) for x in counts if one_edit(w, x)))
        best = near[0][1] if near and -near[0][0] >= ratio * n else None
        form[w] = best
        out.append([w, n, len(near), best, counts[best] if best else None])
    for row in out:
        root = row[0]
        while form[root]:
            root = form[root]
        row.append(root)
    return sorted(map(tuple, out), key=str)


def vocabulary(seed, size, letters="abéÿ", low=6, high=10):
    rng, out = random.Random(seed), {}
    while len(out) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
        out.setdefault(w, rng.choice([5, 5, 6, 30, 31, 200, 1000]))
        if rng.random() < 0.5:  # a variant, often among equal letters
            p = rng.randrange(len(w))
            out.setdefault(rng.choice([w[:p] + w[p] + w[p:], w[:p] + w[p + 1 :] if len(w) > low else w, w[:p] + rng.choice(letters) + w[p + 1 :]]), rng.choice([5, 150, 5000]))
    return out


def test_a_tree_reports_all_points_of_a_rectangle():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 17, 64, 100):
        values = rng.permutation(n)
        tree = WaveletTree(values)
        asked = rng.integers(0, n + 1, (4, 200))
        q, v = tree.report(*asked)
        want = {(k, x) for k, (l, r, a, b) in enumerate(asked.T.tolist()) for x in values[l:r].tolist() if a <= x < b}
        assert len(q) == len(want) and set(zip(q.tolist(), v.tolist())) == want


def test_near_words_of_one_length_by_all_pairs():
    counts = vocabulary(3, 400)
    for length in range(6, 12):
        some = [w for w in counts if len(w) in (length, length - 1)]
        n = np.array([counts[w] for w in some], np.int64)
        for low, high in ((0, length), (0, length // 2), (length // 2, length), (3, 4)):
            near, best = near_words(length, low, high, some, n)
            for k, w in enumerate(some):
                there = []
                for x in some:
                    if length in (len(w), len(x)) and one_edit(w, x):
                        long, short = (w, x) if len(w) >= len(x) else (x, w)
                        first = next((i for i in range(len(short)) if long[i] != short[i]), len(short))
                        if low <= first < high:
                            there.append(x)
                assert near[k] == len(there)
                assert (some[best[k]] if there else None) == min(there, key=lambda x: (-counts[x], x), default=None) and (there or best[k] == -1)


@pytest.mark.parametrize("group,shard", [(20_000, 40_000), (3, 20)])
def test_forms_by_all_pairs(spark, group, shard):
    counts = vocabulary(group, 300)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling_forms(words.selectExpr("*", "1 AS best", "'x' AS root"), group=group, shard=shard)
    assert sorted(map(tuple, got.collect()), key=str) == plain(counts)


def test_one_prefix_of_all_words_is_dealt_anew(spark):
    counts = {f"shared{''.join(chr(97 + (k // 20**j) % 20) for j in range(6))}": 5 + k % 40 for k in range(0, 200_000, 173)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    sizes = dealt(words, 50).groupBy("length", "low", "high", "before", "behind").count().where("high - low > 1").agg({"count": "max"}).first()[0]
    assert sizes <= 50
    assert sorted(map(tuple, spelling_forms(words, group=50).collect()), key=str) == plain(counts)


def words_of(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def test_words_are_those_of_a_plain_loop(spark):
    rng = random.Random(2)
    pool = ["Élève", "ÀÉÎÕÜß", "Étudier", "STRAẞE", "Overall", "overall", "a", "fivee", "sixsix", "日本語abcdef", "KKelvinn", "naïveté"]
    texts = [" ".join(rng.choice(pool) for _ in range(200)) for _ in range(60)] + [None, *ODD, "seveneh " * 300_000]
    got = {r["word"]: r["n"] for r in counted_words(documents(spark, texts)).collect()}
    assert got == words_of(enumerate(texts)) and len(got) > 8


def test_roots_of_long_chains(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(37)] + [(f"x{k}", "w0") for k in range(50)]
    got = dict(map(tuple, roots(spark.createDataFrame(links, "word string, form string")).collect()))
    assert set(got.values()) == {"w37"} and len(got) == 87


def test_odd_tables(spark):
    df = documents(spark, ["spelling spelling", None, "spelling spelling spelling"], ids=[None, 3, None])
    assert [tuple(r) for r in spelling_forms(counted_words(df)).collect()] == [("spelling", 5, 0, None, None, "spelling")]
    assert spelling_forms(counted_words(df.where("false"))).count() == 0
    assert counted_words(df.selectExpr("*", "1 AS word", "2 AS h", "3 AS run")).columns == ["word", "n"]
