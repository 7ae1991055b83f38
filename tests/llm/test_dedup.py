"""Exact, near and substring deduplication against brute force."""

import hashlib
import re
import string

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD, documents, words
from pyspark.sql import functions as F

from tamarack.llm.components import components
from tamarack.llm.exact_dedup import drop_copies, exact_groups
from tamarack.llm.order_minhash import BINS, aligned, band_keys, drop_near_copies, each_words, edits, in_bound, labels_of, near_groups
from tamarack.llm.substring_dedup import remove_repeats, repeated_words
from tamarack.llm.wordhash import mix

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def exact_wanted(texts):
    held = {}
    for k, t in enumerate(texts):
        held.setdefault((t or "").translate(LOWER), []).append(k)
    return {k: (max(ids), len(ids), k == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in held.items() for k in ids}


@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, weak):
    texts = [*ODD, None, "", "ABC é", "abc é", "abc É", "ABC É", *ODD[:6]] * 2
    kind = {"digest": lambda t: F.substring(F.unhex(F.sha2(F.encode(t, "UTF-8"), 256)), 1, 1)} if weak else {}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_groups(documents(spark, texts), **kind).collect()}
    assert got == exact_wanted(texts)


def test_exact_repeated_and_empty(spark):
    twice = documents(spark, ["a", "b"]).unionByName(documents(spark, ["a", "c"]))
    kept = drop_copies(twice)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, "a"), (1, "b"), (1, "c")] and kept.columns == twice.columns
    assert exact_groups(documents(spark, [])).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for k, x in enumerate(a, 1):
        before, row[0] = row[0], k
        for m, y in enumerate(b, 1):
            before, row[m] = row[m], before if x == y else 1 + min(before, row[m], row[m - 1])
    return row[-1]


def test_alignment_is_edit_distance():
    import random

    rng = random.Random(5)
    for _ in range(150):
        v = [rng.randrange(1, rng.choice([5, 2000])) for _ in range(rng.choice([3, 6, 20, 60, 150]))]
        w = list(v)
        for _ in range(rng.randrange(0, 1 + len(v) // 8)):
            at, kind = rng.randrange(len(w)), rng.random()
            w[at : at + (kind < 0.7)] = [] if 0.4 <= kind < 0.7 and len(w) > 1 else [rng.randrange(1, 3000)]
        a, b = (mix(np.array(x, np.uint64)) for x in (v, w))
        exact = 1 - distance(v, w) / max(len(v), len(w))
        got = aligned(a, b, 0.8)
        assert got <= exact + 1e-9 and (exact < 0.8 or got == pytest.approx(exact))


def test_labels_do_not_repeat():
    labels = labels_of(mix(np.array([1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2], np.uint64)))
    assert len(set(labels.tolist())) == len(labels) == 8


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


def near_texts():
    base = words(1, 200)
    out = [" ".join(base)]
    for k in range(40):  # each copy has one word changed
        own = list(base)
        own[5 * k % 200] = f"new{k}"
        out.append(" ".join(own))
    passage = " ".join(words(2, 60))
    out += [" ".join(words(10 + k, 150, 5000)) + " " + passage for k in range(40)]  # a common passage makes no copies
    out += [" ".join(words(99, n)) for n in (4, 4, 5, 9)] + [None, "", "one", "one"]
    # Five shingles, four of them shared.
    out += ["p q r s t u v w", "p q r s t u v w x"]
    return out


def test_near(spark):
    texts = near_texts()
    got = {r.doc_id: r for r in near_groups(documents(spark, texts)).collect()}
    assert {got[k].class_id for k in range(41)} == {0} and got[0].class_size == 41
    assert all(got[k].class_size == 1 for k in range(41, 81))
    assert got[81].class_id == got[82].class_id == 81 and got[85].class_id == got[86].class_id == 85 and got[87].class_id == got[88].class_id == 87
    assert got[89].class_id == got[90].class_id == 89
    left = drop_near_copies(documents(spark, texts))
    assert sorted(r.doc_id for r in left.collect()) == sorted(k for k, r in got.items() if r.kept) and "text" in left.columns


def test_near_repeated_and_empty(spark):
    twice = documents(spark, ["a b c d e f", "g"]).unionByName(documents(spark, ["a b c d e f", "h"]))
    assert sorted((r.doc_id, r.text) for r in drop_near_copies(twice).collect()) == [(0, "a b c d e f"), (1, "g"), (1, "h")]
    assert near_groups(documents(spark, [])).count() == 0


def substring_wanted(texts, window=50):
    seen, out = {}, {}
    for k, t in enumerate(texts):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        gone = [False] * len(w)
        for at in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[at : at + window]), k) < k:
                gone[at : at + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[k] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_substring(spark):
    passage = words(3, 70)
    texts = [" ".join(words(k, 60 + k) + passage[k % 20 :] + words(100 + k, 30)) for k in range(40)]
    texts += [" ".join(passage * 3), "tick tock " * 200, "tick tock " * 90, " ".join(passage[:49]), " ".join(passage[:50]), None, "", *ODD, texts[5], texts[5]]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeated_words(documents(spark, texts)).collect()}
    assert got == substring_wanted(texts)
    cut = {r.doc_id: r for r in remove_repeats(documents(spark, texts)).collect()}
    for k, (_, removed, sha) in got.items():
        if removed:
            assert hashlib.sha256(cut[k].text.encode()).hexdigest() == sha and cut[k].n_chars == len(cut[k].text)
        else:
            assert cut[k].text == texts[k]
    assert repeated_words(documents(spark, [])).count() == 0


def test_mixed_buckets_are_compared_whole(spark):
    """Pairs of little shingle share that meet only as non-leaders of a bucket whose texts share a passage."""
    import random

    rng = random.Random(11)
    passage = words(7, 130, 9000)
    texts = [" ".join(passage + words(1000 + k, 130, 9000)) for k in range(60)]  # leaders and company: alike by half
    for k in range(60, 90):
        own = passage + words(1000 + k, 130, 9000)
        twin = list(own)
        for at in rng.sample(range(130, 260), 26):  # a tenth of all words
            twin[at] = f"x{k}-{at}"
        texts += [" ".join(own), " ".join(twin)]
    words_ = list(each_words(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]), 0))
    keys = [set(band_keys(labels_of(w)).tolist()) for w in words_]
    meet = {k for k in range(60, 120, 2) if keys[k] & keys[k + 1]}
    got = {r.doc_id: r.class_id for r in near_groups(documents(spark, texts)).collect()}
    assert len(meet) > 15 and all(aligned(words_[k], words_[k + 1], 0.8) >= 0.8 for k in meet)
    assert got == {**{k: k for k in range(120)}, **{k + 1: k for k in meet}}


def test_long_gaps_are_aligned():
    v = list(range(1, 201))
    w = [x + 5000 if 50 <= k < 150 and k % 4 == 0 else x for k, x in enumerate(v)]
    a, b = (mix(np.array(x, np.uint64)) for x in (v, w))
    assert distance(v, w) == 25 and aligned(a, b, 0.8) == pytest.approx(0.875)


def test_edits_to_a_bound():
    import random

    rng = random.Random(6)
    for _ in range(300):
        v, w = ([rng.randrange(6) for _ in range(rng.randrange(90))] for _ in range(2))
        exact, most = distance(v, w), rng.randrange(90)
        got = edits(v, w, most)
        assert got == exact if exact <= most else got > most


def test_short_texts_meet_by_one_label(spark):
    texts = [" ".join([*words(300 + k, 5, 9000), end]) for k in range(40) for end in ("this", "that")]
    got = {r.doc_id: r.class_id for r in near_groups(documents(spark, texts)).collect()}
    assert got == {k: k - k % 2 for k in range(80)}


def test_bound_leaves_out_no_pair_alike():
    import random

    rng = random.Random(8)
    for _ in range(60):
        base = [rng.randrange(1, 60) for _ in range(rng.choice([5, 40, 600]))]
        texts = [[rng.randrange(1, 60) if rng.random() < p else x for x in base] for p in (0, 0.05, 0.15, 0.3, 1)] + [base * 3]
        hashes = [mix(np.array(x, np.uint64)) for x in texts]
        bins = np.array([np.minimum(np.bincount((h & np.uint64(BINS - 1)).astype(int), minlength=BINS), 255) for h in hashes], np.uint8)
        sizes = np.array([len(x) for x in texts])
        for k, x in enumerate(texts):
            may = in_bound(bins[k : k + 1], bins, np.array([0.2 * max(len(x), 1) + 1e-9]))[0]
            assert all(may[m] or distance(x, y) > 0.2 * len(x) for m, y in enumerate(texts) if sizes[m] <= sizes[k])


def test_names_of_further_columns_may_clash(spark):
    texts = ["a b c", "a b c", "A b c", " ".join(words(5, 90)), " ".join(words(5, 90)) + " end", None]
    docs = documents(spark, texts).withColumnsRenamed({"id": "__id", "n": "__n"})
    docs = docs.withColumns({c: F.concat(F.lit(c), "doc_id") for c in ("__key", "__sha", "__runs", "row", "key", "sha", "__slot", "__block", "a.b")})
    for drop in (drop_copies, drop_near_copies, remove_repeats):
        got = drop(docs).collect()
        assert got and drop(docs).columns == docs.columns
        assert all(r["__id"] == "x" and r["__n"] == 1 and all(r[c] == f"{c}{r.doc_id}" for c in docs.columns[7:]) for r in got)


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "a b"), (None, "c")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in drop_copies(docs).collect()) == [("3", "a b"), ("None", "c")]
    assert sorted((str(r.doc_id), r.text) for r in drop_near_copies(docs).collect()) == [("None", "a b"), ("None", "c")]
    assert len(remove_repeats(docs).collect()) == 4
