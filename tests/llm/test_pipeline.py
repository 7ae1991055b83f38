"""Each stage of the pipeline over all documents of sf0.001 against a plain version on its own input."""

import os
import re
from collections import Counter

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\\x20\\x09-\\x0d]+")


@pytest.fixture(scope="module")
def stages(spark):
    """(rows in, rows out) of each stage, in order."""
    import corpus_pipeline

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        done = corpus_pipeline.materialize(stage(spark, docs, SF), f"plain{k}")
        out.append((docs.collect(), done.collect()))
        docs = done
    return out


pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def aligned(a, b):
    """1 less the edits of the word alignment over the longer text."""
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return 1 - row[-1] / max(1, len(a))


def test_the_classifier_keeps_what_its_query_accepts(spark, stages):
    from tamarack.llm.quality import op9_quality_classifier

    rows, left = stages[0]
    good = Counter(r.doc_id for r in op9_quality_classifier(spark, SF).collect() if r.predicted == 1)
    assert Counter(r.doc_id for r in left) == good and 0 < len(left) < len(rows)
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[r.doc_id] == r for r in left)


def test_of_equal_texts_the_last_row_stays(stages):
    rows, left = stages[1]
    lowered = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    last = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        last[lowered(r.text)] = r
    assert sorted(r.doc_id for r in left) == sorted(r.doc_id for r in last.values()) and len(left) < len(rows)


def test_no_two_near_copies_stay_and_only_near_copies_go(stages):
    rows, left = stages[2]
    kept = {r.doc_id for r in left}
    assert kept <= {r.doc_id for r in rows} and len(kept) < len(rows)
    texts = [(r.doc_id, shingles(r.text), WORD.findall(r.text or "")) for r in rows]
    for k, (a, x, _) in enumerate(texts):
        if a in kept:
            for b, y, _ in texts[k + 1 :]:
                if b in kept and x and y and len(x & y) >= 0.8 * len(x | y):
                    raise AssertionError(f"{a} and {b} both stay")
    # Links are alignments of 0.8 or more: following them, each that went leads to one that stayed.
    gone = [t for t in texts if t[0] not in kept]
    near = {a: {b for b, y, v in texts if b != a and len(x & y) > 0.1 * max(1, len(x | y)) and min(len(w), len(v)) >= 0.8 * max(len(w), len(v)) and aligned(w, v) >= 0.8} for a, x, w in gone}
    for a in near:
        seen, todo = {a}, [a]
        while todo and not seen & kept:
            more = near.get(todo.pop(), set()) - seen
            seen |= more
            todo += more
        assert seen & kept, f"{a} went alone"


def test_words_of_earlier_windows_go(stages):
    rows, left = stages[3]
    first, windows = {}, {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        w = windows[r.doc_id] = WORD.findall(r.text or "")
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), r.doc_id)
    got, removed = {r.doc_id: r.text for r in left}, 0
    for doc_id, w in windows.items():
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < doc_id:
                gone.update(range(k, k + 50))
        removed += len(gone)
        if gone:
            assert WORD.findall(got.get(doc_id) or "") == [x for k, x in enumerate(w) if k not in gone]
        elif w:
            assert got[doc_id] == next(r.text for r in rows if r.doc_id == doc_id)
    assert removed > 0


def test_every_piece_has_its_place(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows, pieces = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    size = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in rows}
    assert {p.doc_id for p in pieces} == set(size)
    total, filled = Counter(), {}
    for p in pieces:
        total[p.doc_id] += p.length
        filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert dict(total) == size
    for held in filled.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(filled) <= 1.1 * -(-sum(size.values()) // 2048) + 1


def test_a_worker_keeps_the_state_of_one_operator():
    import weakref

    from tamarack.llm.common import forget, kept

    class State:
        pass

    first = weakref.ref(kept(("first",), State))
    assert first() is kept(("first",), State)
    second = weakref.ref(kept(("second",), State))
    assert first() is None and second() is not None
    forget()
    assert second() is None


def test_batches_for_python_are_bounded_in_bytes(spark, stages):
    import pyarrow as pa

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    rows = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 4000) AS text")
    assert max(r.n for r in rows.mapInArrow(held, "n long").collect()) < 2100
