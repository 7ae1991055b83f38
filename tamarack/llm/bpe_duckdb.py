"""Byte-level BPE encoding and decoding by recursive queries.

Each worker holds an in-memory DuckDB with the table of merges: every pair of
tokens whose bytes joined are a token, which then is its rank. The distinct words
(matches of the splitting pattern) that a worker has not met become token-position
rows; a recursive query joins neighbours with the merges and contracts each word's
leftmost pair of least rank until no pair of any word is left; the tokens that are
left, in order, take their ids' digits and their bytes from two Arrow columns. Words longer than LONG bytes, on
which one contraction a step would be quadratic, follow the same rule by a heap.
Texts are cut before spaces as in `token_counts`, so that each distinct unit of some
megabytes of text is looked up once and of those that a worker remembers split once.

Null texts count as empty ones (no ids; both digests of the empty string);
repeated rows each give a row; an empty table an empty table; further columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UNSAFE_CUT, gathered, in_groups, joined_slices, kept, table, unit_text
from .token_counts import Known

#: Words a query takes, rows of all its steps at most, bytes from which a word goes by the heap, words and units that a worker
#: remembers, characters of texts whose units are looked up together.
BATCH_WORDS, BATCH_ROWS, LONG, CACHE_UNITS, GROUP_CHARS = 10_000, 2_000_000, 256, 1_000_000, 4_000_000

#: A row is a token at a position of word w, with the token and position after it as one number (-1 at the word's end).
#: A step's least (rank, position, position after it) of each word is one number too; words without any are done.
CONTRACT = """
WITH RECURSIVE state AS (
    SELECT w, pos, tok, coalesce(lead((tok::BIGINT << 16) | pos) OVER (PARTITION BY w ORDER BY pos), -1) AS next, false AS done FROM start
    UNION ALL
    SELECT p.w, p.pos,
        CASE WHEN p.pos = (b.key >> 16) & 65535 THEN (b.key >> 32)::INTEGER ELSE p.tok END AS tok,
        CASE WHEN p.pos = (b.key >> 16) & 65535 THEN b.after
             WHEN p.next >= 0 AND p.next & 65535 = (b.key >> 16) & 65535 THEN ((b.key >> 32) << 16) | ((b.key >> 16) & 65535)
             ELSE p.next END AS next,
        b.key IS NULL AS done
    FROM state p LEFT JOIN (
        SELECT l.w, l.key, r.next AS after
        FROM (
            SELECT s.w, min((m.merged::BIGINT << 32) | (s.pos::BIGINT << 16) | (s.next & 65535)) AS key
            FROM state s JOIN merges m ON m.pair = (s.tok::BIGINT << 32) | (s.next >> 16) WHERE NOT s.done AND s.next >= 0 GROUP BY s.w
        ) l JOIN state r ON r.w = l.w AND r.pos = l.key & 65535
    ) b ON b.w = p.w
    WHERE NOT p.done AND (b.key IS NULL OR p.pos <> b.key & 65535)
)
SELECT s.w, s.tok FROM state s WHERE s.done ORDER BY s.w, s.pos
"""

DECODE = """
SELECT i.w, unhex(string_agg(t.hex, '' ORDER BY i.pos)) AS bytes FROM ids i JOIN tokens t ON t.id = i.tok GROUP BY i.w
"""


class RecursiveBpe:
    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        #: By id: its digits after a space, and its bytes.
        bytes_of = {i: b for b, i in self.ranks.items()}
        self.digits = pa.array([b" %d" % i for i in range(max(bytes_of) + 1)], pa.large_binary())
        self.token_bytes = pa.array([bytes_of.get(i) for i in range(max(bytes_of) + 1)], pa.large_binary())
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b), merged.append(rank)
        # Without a folder to spill to: batches are bounded instead.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "350MB", "temp_directory": ""})
        held = pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32())})
        names = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks]})
        for name, rows in (("merges", held), ("tokens", names)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        #: Decimal ids of words and units, a space before each; with the decoded bytes where these aren't the word's own.
        #: A word, being a match of the pattern, is split into itself, so that one name serves for both.
        self.known = Known(CACHE_UNITS)

    def heap_encode(self, data: bytes) -> list[int]:
        """Leftmost least-rank contraction of one long word."""
        part, n = [data[k : k + 1] for k in range(len(data))], len(data)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue = [(self.ranks[data[k : k + 2]], k, 2) for k in range(n - 1) if data[k : k + 2] in self.ranks]
        heapq.heapify(queue)
        while queue:
            _, k, size = heapq.heappop(queue)
            j = after[k] if alive[k] else n
            if j >= n or len(part[k]) + len(part[j]) != size:
                continue
            part[k] += part[j]
            alive[j], after[k] = False, after[j]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (rank := self.ranks.get(both := part[a] + part[b])) is not None:
                    heapq.heappush(queue, (rank, a, len(both)))
        return [self.ranks[part[k]] for k in range(n) if alive[k]]

    def query_encode(self, words: list[bytes]) -> list[str]:
        """The decimal ids of each word by the recursive query."""
        return [ids[1:].decode() for ids, _ in self.query_both(words)]

    def query_both(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """The decimal ids of each word by the recursive query, a space before each, and what they decode to."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        rows = pa.table({
            "w": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
            "pos": (np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int32),
            "tok": self.byte_ids[np.frombuffer(b"".join(words), np.uint8)],
        })
        self.db.register("start", rows)
        got = self.db.execute(CONTRACT).fetchnumpy()
        self.db.unregister("start")
        tokens, at = pa.array(np.asarray(got["tok"])), np.searchsorted(np.asarray(got["w"]), np.arange(len(words) + 1))
        return [(bytes(a), bytes(b)) for a, b in zip(*(joined_slices(names.take(tokens), at) for names in (self.digits, self.token_bytes)))]

    def decode(self, ids: list[str]) -> list[bytes]:
        """The bytes of each sequence of decimal ids, by an ordered aggregation."""
        split = [list(map(int, x.split())) for x in ids]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        rows = pa.table({"w": np.repeat(np.arange(len(ids), dtype=np.int32), sizes), "pos": np.arange(sizes.sum(), dtype=np.int64), "tok": np.fromiter((t for x in split for t in x), np.int32, int(sizes.sum()))})
        self.db.register("ids", rows)
        out = [b""] * len(ids)
        for w, data in self.db.execute(DECODE).fetchall():
            out[w] = bytes(data)
        self.db.unregister("ids")
        return out

    def learn_words(self, words: Iterable[str]) -> None:
        short = []
        for word in words:
            data = word.encode()
            if len(data) <= LONG:
                short.append((word, data))
            else:
                ids = " ".join(map(str, self.heap_encode(data)))
                self.note(word, data, f" {ids}".encode(), self.decode([ids])[0])
        short.sort(key=lambda x: len(x[1]))  # words of like length end after like steps
        at = 0
        while at < len(short):
            # A step adds the rows of a word again, so that a word of n bytes has n * n / 2 rows at most.
            upto, rows = at, 0
            while upto < len(short) and upto - at < BATCH_WORDS and (upto == at or rows < BATCH_ROWS):
                rows += len(short[upto][1]) ** 2 // 2
                upto += 1
            some = short[at:upto]
            for (word, data), (ids, back) in zip(some, self.query_both([data for _, data in some])):
                self.note(word, data, ids, back)
            at = upto

    def note(self, word: str, data: bytes, ids: bytes, back: bytes) -> None:
        self.known[word] = ids if back == data else (ids, back)

    def learn(self) -> None:
        """Encodes the units and words noted as new."""
        known = self.known
        split = {unit: self.split(unit) for unit in set(known.new)}
        known.new.clear()
        for word in {w for x in split.values() for w in x}:
            known[word]  # notes what is new
        words = list(dict.fromkeys(known.new))
        known.new.clear()
        self.learn_words(words)
        for unit, x in split.items():
            if x != [unit]:
                ids, back = self.joined(x)
                known[unit] = ids if back == unit.encode() else (ids, back)

    def values(self, units: list[str]) -> tuple[list[bytes], list[bytes | str]]:
        """The ids and the decoded text of each unit."""
        got = list(map(self.known.__getitem__, units))
        if self.known.new:
            self.learn()
            got = [self.known[u] if x is None else x for u, x in zip(units, got)]
        own = [x if type(x) is bytes else x[0] for x in got]
        return own, [u if type(x) is bytes else x[1] for u, x in zip(units, got)]

    def joined(self, words: list[str]) -> tuple[bytes, bytes]:
        ids, texts = self.values(words)
        return b"".join(ids), b"".join([x.encode() if type(x) is str else x for x in texts])

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[int, str, str]]:
        """(n_tokens, ids_sha256, decoded_sha256) of each text."""
        ids, data, n = hashlib.sha256(), hashlib.sha256(), 0
        for some in in_groups(texts, GROUP_CHARS):
            self.known.turn()
            heads, rests = [], []
            for _, block in some:
                # What comes before the first space, or a block that may not be cut, is split by itself.
                head, space, rest = (block, "", "") if UNSAFE_CUT.search(block) else block.replace("\n", " \n").partition(" ")
                heads.append(self.split(head))
                rests.append(rest if space else None)
            self.values(list({w for x in heads for w in x}))
            for (last, _), head, (part, back) in zip(some, heads, gathered(rests, lambda keys: self.values(list(map(unit_text, keys))))):
                first, start = self.joined(head)
                own = first + part
                ids.update(own if n else own[1:])
                data.update(start)
                data.update(back)
                n += own.count(b" ")
                if last:
                    yield n, ids.hexdigest(), data.hexdigest()
                    ids, data, n = hashlib.sha256(), hashlib.sha256(), 0


def held(path: str, pattern: str) -> RecursiveBpe:
    """One database a worker process and vocabulary."""
    return kept(("bpe", path, pattern), lambda: RecursiveBpe(path, pattern))


def encode_decode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row; `ranks` is a rank file that every executor has."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(ranks, pattern)
        for batch in batches:
            out = list(bpe.encode(x.as_py() for x in batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.string())], schema=schema)

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe_duckdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
