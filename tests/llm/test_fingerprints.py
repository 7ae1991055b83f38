"""Fingerprints against a plain version, and likeness against shingle sets."""

import hashlib
import struct

import xxhash
from llm_cases import ODD, documents, words

from tamarack.llm.fingerprints import BINS, BITS, TRIES, draws, fingerprints


def xx(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def plain(text):
    ws = [w for w in __import__("re").split(r"[ \t\n\x0b\f\r]+", text) if w]
    hashed = [xx(w.encode()) for w in ws]
    bins, low = {}, 63 - (BINS - 1).bit_length()
    for k in range(max(1, len(ws) - 4)):
        h = 42
        for x in hashed[k : k + 5]:
            h = xx(struct.pack("<Q", x), h)
        h >>= 1
        bins[h >> low] = min(bins.get(h >> low, 1 << 64), h & (1 << low) - 1)
    out, tries = [], draws()
    for b in range(BINS):
        own = next((bins[c] for c in (b, *[tries[t][b] for t in range(TRIES)]) if c in bins), None)
        if own is None:
            ranked = min(((xx(struct.pack("<i", c), xx(struct.pack("<i", b))) >> 1 & -BINS) + c, c) for c in bins)
            own = bins[ranked[1]]
        out.append(xx(struct.pack("<i", b), xx(struct.pack("<q", own))) & (1 << BITS) - 1)
    each = 64 // BITS
    return "".join(f"{sum(v << j * BITS for j, v in enumerate(out[k : k + each])):016x}" for k in range(0, BINS, each))


def shingles(text):
    w = text.split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def test_fingerprints(spark):
    texts = [*[t for t in ODD if "\x1c" not in t and "\x85" not in t and "　" not in t], None, " ".join(words(1, 2000, 9000)), " ".join(words(1, 2000, 9000)), " ".join(words(2, 300)), ODD[3]]
    got = {r.doc_id: r for r in fingerprints(documents(spark, texts)).collect()}
    full = [t or "" for t in texts]
    for k, text in enumerate(full):
        after, h = full[(k + 1) % len(full)], len(text) // 2
        edited = text[: len(text) - h] + after[:h]
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (plain(text), plain(edited))
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = shingles(text), shingles(other)
            assert abs(near - len(a & b) / len(a | b)) < 0.16
    same = [k for k, t in enumerate(full) if full.count(t) > 1]
    assert len({got[k].fingerprint for k in same}) < len(same)


def test_edges(spark):
    assert fingerprints(documents(spark, [])).count() == 0
    (r,) = fingerprints(documents(spark, ["a b c"])).collect()
    assert r.near_next == 1.0
    assert fingerprints(documents(spark, ["x", "y"]).unionByName(documents(spark, ["x", None], [0, None]))).count() == 4
