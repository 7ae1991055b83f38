"""Packing, token counts and BPE against the libraries."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from llm_cases import ODD, documents, words

from tamarack.llm.bpe_duckdb import RecursiveBpe, encode_decode
from tamarack.llm.packing import match_lengths, pack_documents, placements
from tamarack.llm.token_counts import count_tokens

TEXTS = [*ODD, None, ODD[3], " ".join(words(1, 9000))]


def test_counts_are_the_librarys(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in count_tokens(documents(spark, TEXTS), P.path("byte_bpe_50k.json")).collect()}
    for k, text in enumerate(TEXTS):
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (got[k].n_tokens, got[k].n_bytes, got[k].over_limit) == (n, len((text or "").encode()), n > 1024)
    assert count_tokens(documents(spark, []), P.path("byte_bpe_50k.json")).count() == 0


def test_bpe_is_the_librarys(spark):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in encode_decode(documents(spark, TEXTS), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    for k, text in enumerate(TEXTS):
        ids = enc.encode_ordinary(text or "")
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert encode_decode(documents(spark, []), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_heap_and_query_agree():
    bpe = RecursiveBpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    some = [w.encode() for w in ("internationalization", "aaaaaaaaaaaaaaa", "ñandú", "!?!?!?...", "0123456789" * 5)]
    assert bpe.query_encode(some) == [" ".join(map(str, bpe.heap_encode(w))) for w in some]


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = pack_documents(documents(spark, TEXTS), P.path("word_bpe_49k.json")).collect()
    wanted = {}
    for k, text in enumerate(TEXTS):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 2048):
            wanted[k, at // 2048] = (at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == wanted
    assert check_packing(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 1
    assert pack_documents(documents(spark, []), P.path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(c) for n, c in zip(rng.integers(1, 101, 60), rng.integers(1, 50, 60))}
    bins = match_lengths(counts, 100)
    held = {}
    for many, holds in bins:
        assert sum(n * k for n, k in holds) <= 100 and sum(k for n, k in holds if 3 * n > 100) <= 2
        for n, k in holds:
            held[n] = held.get(n, 0) + many * k
    assert held == counts
    ends = {}
    for n, low, high, *_ in placements(bins):
        assert low == ends.get(n, 0)
        ends[n] = high
    assert ends == counts


#: Over the size of a block: words, one endless word, spaces and line ends alone, mixed scripts.
LONG_TEXTS = ["some words, and more. " * 60_000, "z" * 300_000, " \n" * 600_000, "日本語 text été \n\n" * 80_000]


def test_long_texts():
    import tiktoken
    from tokenizers import Tokenizer

    from tamarack.llm.token_counts import UnitEncoder

    counts, words_ = UnitEncoder(P.path("byte_bpe_50k.json"), len), UnitEncoder(P.path("word_bpe_49k.json"), len)
    t, w = Tokenizer.from_file(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc, bpe = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), RecursiveBpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for text, ours, of_words, (n, ids_sha, back_sha) in zip(LONG_TEXTS, counts.parts(LONG_TEXTS, True), words_.parts(LONG_TEXTS, False), bpe.encode(LONG_TEXTS)):
        assert sum(map(sum, ours)) == len(t.encode(text, add_special_tokens=False).ids)
        assert sum(map(sum, of_words)) == len(w.encode(text, add_special_tokens=False).ids)
        assert back_sha == hashlib.sha256(text.encode()).hexdigest()
        if not text.strip():
            continue  # the library itself gives up on so much white space
        ids = enc.encode_ordinary(text)
        assert n == len(ids) and ids_sha == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_small_memories_change_nothing():
    from tokenizers import Tokenizer

    from tamarack.llm.token_counts import UnitEncoder

    texts = [" ".join(f"{w}," if k % 5 == 0 else w for k, w in enumerate(words(seed, 300, 5000))) for seed in range(40)]
    for path, spaced in ((P.path("byte_bpe_50k.json"), True), (P.path("word_bpe_49k.json"), False)):
        small, t = UnitEncoder(path, len, cache_units=200), Tokenizer.from_file(path)
        for at in range(0, len(texts), 4):
            got = [sum(map(sum, parts)) for parts in small.parts(texts[at : at + 4], spaced)]
            assert got == [len(t.encode(x, add_special_tokens=False).ids) for x in texts[at : at + 4]]
        assert len(small.known) + len(small.known.old) < 6000


def test_words_without_a_pair_and_words_of_one_token():
    bpe = RecursiveBpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    some = [b"a", b"the", b"\xf0\x9f\x98\x80", b"qzqzqz", b" "]
    assert [back for _, back in bpe.query_both(some)] == some
    assert bpe.query_encode(some) == [" ".join(map(str, bpe.heap_encode(w))) for w in some]


def test_repeated_units_are_looked_up_once():
    from tokenizers import Tokenizer

    from tamarack.llm.common import gathered
    from tamarack.llm.token_counts import UnitEncoder

    asked = []
    got = list(gathered(["a b  a", None, "", "b"] * 50, lambda units: (asked.extend(units) or [x.encode() + b"." for x in units],)))
    assert [bytes(x) for (x,) in got] == [b"a.b..a.", b"", b".", b"b."] * 50 and sorted(asked) == ["", "a", "b"]
    enc, t = UnitEncoder(P.path("word_bpe_49k.json"), lambda ids: np.array(ids, "<u4").tobytes(), cache_units=200), Tokenizer.from_file(P.path("word_bpe_49k.json"))
    some = [x or "" for x in TEXTS]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.joined(some)] == [t.encode(x, add_special_tokens=False).ids for x in some]


def test_frequent_words_outlive_the_memory(monkeypatch):
    """A full memory of words used to be emptied, so that common words too were encoded anew."""
    import tamarack.llm.bpe_duckdb as bpe_duckdb

    monkeypatch.setattr(bpe_duckdb, "CACHE_UNITS", 400)
    bpe, asked = RecursiveBpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), []
    query = bpe.query_both
    monkeypatch.setattr(bpe, "query_both", lambda some: asked.extend(some) or query(some))
    for k in range(12):
        text = "common " * 9 + " ".join(f"own{chr(97 + k)}{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(150))
        ((_, _, back),) = bpe.encode([text])
        assert back == hashlib.sha256(text.encode()).hexdigest()
    assert asked.count(b" common") == 1 and len(bpe.known) + len(bpe.known.old) < 1000
