"""Token counts: lengths only, over Arrow batches.

Texts are cut into units, a word with the space or line end before it; the library encodes
each unit that a worker has not met before, in batches of about equal bytes, and
a text's count is the sum over its units. Such a cut changes nothing where the
pre-tokenizer ends every match there, which holds unless more white space stands
on both sides of it; such texts are encoded whole, and when long in blocks cut
between a word and the white space after it.

Nulls count as empty texts (0 tokens); repeated rows each give a row; further
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, gathered, kept, table, unit_keys, unit_text

#: Units a worker remembers, characters of text given to one call of the library.
CACHE_UNITS, BATCH_CHARS, BLOCK_CHARS = 1_000_000, 256_000, 64_000


#: A word of Latin letters with signs after it: two matches of any pre-tokenizer used here.
WORD_AND_SIGNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*%#$&|]+)").fullmatch


def lower_latin(text: str) -> str:
    """The text in lower case, for vocabularies that are, where that cannot change their reading: Latin letters, no special strings."""
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class Known(dict):
    """Values of units, in two generations of at most half of `limit` and a group: the older one goes when the younger is full.

    A lookup of what neither has gives None and is noted in `new`.
    """

    def __init__(self, limit: int):
        self.limit, self.old, self.new = limit, {}, []

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            self.new.append(key)
        else:
            self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.limit // 2:
            self.old = self.copy()
            self.clear()


class UnitEncoder:
    """Encodes units through a `tokenizers` vocabulary and keeps value(ids) of each; values of parts must add up."""

    def __init__(self, path: str, value, cache_units: int = CACHE_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.value = Tokenizer.from_file(path), value
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = Known(cache_units)

    def encode(self, texts: list[str]) -> list:
        """value(ids) of each text, in library calls of about BATCH_CHARS."""
        out, batch, size = [], [], 0
        for t in texts:
            batch.append(t)
            size += len(t)
            if size >= BATCH_CHARS:
                out += [self.value(e.ids) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
                batch, size = [], 0
        if batch:
            out += [self.value(e.ids) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        return out

    def learn(self, spaced: bool) -> None:
        """Encodes the units noted as new."""
        known = self.known
        new = set(known.new)
        known.new.clear()
        if spaced:
            known.update(zip(new, self.encode([unit_text(u) for u in new])))
            return
        # A word and the signs after it are encoded apart: most words are known without them.
        apart = {u: m.groups() for u in new if (m := WORD_AND_SIGNS(u))}
        for x in {x for both in apart.values() for x in both}.union(new.difference(apart)):
            known[x]  # notes what is new
        whole = list(dict.fromkeys(known.new))
        known.new.clear()
        known.update(zip(whole, self.encode(whole)))
        known.update((u, known[a] + known[b]) for u, (a, b) in apart.items())

    def parts(self, texts: list[str], spaced: bool) -> Iterator[list[list]]:
        """For each text the values of its parts, a list for each block of it; units new to the worker are encoded together.

        spaced: units keep the white space before them (byte-level vocabularies); else it only separates.
        """
        value = self.known.__getitem__
        self.known.turn()
        cut = []
        for t in texts:
            own = []
            for block in blocks(t, 1 << 20):
                keys = unit_keys(block) if spaced else lower_latin(block).replace("\n", " ").split(" ")
                if keys is None:
                    own.append((block, None, None))
                    continue
                start = keys.pop(0) if spaced and keys[0][:1] != "\n" else None
                own.append((start, keys, list(map(value, keys))))
            cut.append(own)
        if self.known.new:
            self.learn(spaced)
        for own in cut:
            out = []
            for block, keys, values in own:
                if keys is None:
                    out.append(self.encode(list(blocks(block, BLOCK_CHARS))))
                    continue
                if None in values:
                    values = list(map(value, keys))
                out.append(values if block is None else self.encode([block]) + values)
            yield out

    def joined(self, texts: list[str]) -> Iterator[memoryview]:
        """For each text the values (bytes) of its units one after the other; white space only separates, as `spaced` false above."""
        known = self.known
        known.turn()

        def values(units: list[str]) -> tuple[list]:
            out = list(map(known.__getitem__, units))
            if known.new:
                self.learn(False)
                out = [known[u] if x is None else x for u, x in zip(units, out)]
            return (out,)

        return (own for (own,) in gathered([lower_latin(t).replace("\n", " ") for t in texts], values))


def groups(batch: pa.RecordBatch, column: int, size: int = 1 << 20, rows: int = 500) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of successive rows of a batch with about so many bytes."""
    first, texts, held = 0, [], 0
    for k, (value, n) in enumerate(zip(batch.column(column), pc.binary_length(batch.column(column)).to_pylist())):
        texts.append(value.as_py())
        held += n
        if held >= size or len(texts) >= rows:
            yield first, texts
            first, texts, held = k + 1, [], 0
    if texts:
        yield first, texts


def encoder(path: str, value, kind: str, cache_units: int = CACHE_UNITS) -> UnitEncoder:
    """One encoder a worker process, vocabulary and kind of value."""
    return kept(("units", path, kind, cache_units), lambda: UnitEncoder(path, value, cache_units))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row; `vocabulary` is a tokenizers .json file that every executor has."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, len, "len")
        for batch in batches:
            ids, sizes, counts = batch.column(0), [], []
            for _, texts in groups(batch, 1):
                sizes += [len(t.encode()) for t in texts]
                counts += [sum(map(sum, parts)) for parts in enc.parts(texts, spaced=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())], schema=schema)

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
