"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby shift their scores.

Each kind is a row of KINDS: a pattern whose matches are proposed, a test that may
confirm one (number parts, Luhn, remainder 97), and words that make it likelier where
they stand near. A span's score is the kind's prior, plus CONFIRMED if its test passes,
plus NEARBY if one of the words stands in the 40 code points before it or the 20
after it (up to the next match of the kind). Base kinds (email, ip, card, phone) are
kept where their test passes, whatever the score; further kinds (iban, ssn,
local_phone) where, besides, the score reaches the threshold.

All of it is column expressions over a row: no shuffle, no Python on the executors, and
a text's matches cost time in proportion to its length (patterns are possessive where
a plain one would go back over a long run; places are running sums in blocks).

Null texts count as empty ones (no spans); repeated rows each give a row; null ids
stay; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


class Kind(NamedTuple):
    name: str
    pattern: str  #: as Java matches it
    plain: str  #: the same for engines without possessive counts
    prior: float
    test: str  #: SQL over m, a match, and before and after, the texts next to it
    words: str  #: of context, as alternatives
    base: bool = False


#: Score of a passed test and of a word nearby, least score of kinds that are no base ones, code points looked at.
CONFIRMED, NEARBY, LEAST, LEFT, RIGHT = 0.3, 0.25, 0.6, 40, 20

#: Sums of a number's digits are taken from the right, each second one doubled.
LUHN = "aggregate(transform(split(reverse({d}), ''), (c, i) -> CASE WHEN i % 2 = 0 THEN int(c) ELSE int(c) * 2 - IF(int(c) > 4, 9, 0) END), 0, (s, v) -> s + coalesce(v, 0)) % 10 = 0"
DIGITS = "regexp_replace(m, '[^0-9]', '')"
#: Of an IBAN, its first four characters moved to the end, letters as 10 to 35.
MOD97 = "aggregate(split(concat(substring({d}, 5), substring({d}, 1, 4)), ''), 0, (s, c) -> CASE WHEN c = '' THEN s WHEN c BETWEEN '0' AND '9' THEN (s * 10 + int(c)) % 97 ELSE (s * 100 + ascii(c) - 55) % 97 END) = 1"
COMPACT = "replace(m, ' ', '')"

KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0.65, "true", "mail|email|contact|write", True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", 0.3, "forall(split(m, '[.]'), p -> double(p) <= 255)", "ip|host|server|address|ping", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9])+", 0.3, f"CASE WHEN length({DIGITS}) BETWEEN 14 AND 19 THEN {LUHN.format(d=DIGITS)} ELSE false END", "card|visa|mastercard|amex|credit|debit|payment", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.5, f"length({DIGITS}) BETWEEN 10 AND 15", "phone|tel|telephone|call|mobile|cell|fax|whatsapp", True),
    Kind("iban", r"[A-Za-z0-9]{15,}+|[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?", r"[A-Za-z0-9]{15,}|[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?", 0.3,
         f"CASE WHEN length({COMPACT}) BETWEEN 15 AND 34 AND rlike(m, '^[A-Z][A-Z][0-9][0-9][A-Z0-9 ]+$') AND NOT rlike(before, '[A-Za-z0-9]$') AND NOT rlike(after, '^[A-Za-z0-9]') THEN {MOD97.format(d=COMPACT)} ELSE false END", "iban|account|bank|konto|compte|cuenta|bic|swift"),
    Kind("ssn", r"(?<![0-9])[0-9]++-[0-9]++-[0-9]++", r"[0-9]+-[0-9]+-[0-9]+", 0.1,
         "rlike(m, '^[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}$') AND NOT rlike(m, '^000|^666|-00-|-0000$') AND NOT rlike(before, '[A-Za-z0-9-]$') AND NOT rlike(after, '^[A-Za-z0-9-]')", "ssn|social security|social-security"),
    Kind("local_phone", r"[(]?[0-9]{3}[)]?[\x20.-][0-9]{3}[.-][0-9]{4}", r"[(]?[0-9]{3}[)]?[\x20.-][0-9]{3}[.-][0-9]{4}", 0.1, "NOT rlike(before, '[A-Za-z0-9]$|[0-9+][ ().-]{1,3}$|[+]$') AND NOT rlike(after, '^[.-]?[A-Za-z0-9]')", "phone|tel|telephone|call|mobile|cell|fax|whatsapp"),
]
#: ssn and local_phone need a confirmed shape and a word; an iban its remainder alone.
NEEDED = {"iban": 0.6, "ssn": 0.65, "local_phone": 0.65}

#: Matches whose places are summed at once: the work grows with BLOCK a match, not with the number of matches.
BLOCK = 256


def let(name: str, value: str, body: str) -> str:
    """SQL of body, in which name stands for value; a column named in a lambda would be computed anew for each element."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running_sums(lengths: str) -> str:
    """SQL of the running sums of an array of bigint."""
    add = "aggregate({x}, named_struct('a', cast(array() AS array<bigint>), 's', {first}), (t, v) -> named_struct('a', concat(t.a, array(t.s + v)), 's', t.s + v), t -> t.a)"
    cut = f"transform(sequence(0, (size(l) - 1) div {BLOCK}), b -> slice(l, int(b) * {BLOCK} + 1, {BLOCK}))"
    first = add.format(x="transform(bs, x -> aggregate(x, 0L, (s, v) -> s + v))", first="0L")
    inside = add.format(x="x", first="IF(b = 0, 0L, fs[b - 1])")
    whole = let("bs", cut, let("fs", first, f"flatten(transform(bs, (x, b) -> {inside}))"))
    return let("l", lengths, f"IF(size(l) = 0, l, {whole})")


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans(docs: DataFrame, text: Column, least: dict[str, float] | None = None) -> DataFrame:
    """docs with the column `spans`: array of (start, k, end, kind, score, base) in order of start and kind; code points, end exclusive."""
    least = NEEDED | (least or {})
    own = docs.columns
    parts = []
    for k, kind in enumerate(KINDS):
        pattern = _sql(kind.pattern)
        near = f"rlike(lower(concat(x.before, ' ', x.after)), {_sql(f'(^|[^a-z])({kind.words})([^a-z]|$)')})"
        score = f"round(double({kind.prior + CONFIRMED}) + IF({near}, double({NEARBY}), 0D), 2)"
        proposed = f"transform(f, (m, i) -> named_struct('m', m, 'e', e[i], 'before', right(g[i], {LEFT}), 'after', left(g[i + 1], {RIGHT})))"
        scored = f"transform(filter({proposed}, x -> {_of_match(kind.test)}), x -> named_struct('start', x.e - length(x.m), 'k', {k}, 'end', x.e, 'kind', '{kind.name}', 'score', {score}, 'base', {str(kind.base).lower()}))"
        kept = scored if kind.base else f"filter({scored}, s -> s.score >= {least.get(kind.name, LEAST)})"
        ends = running_sums("transform(f, (m, i) -> bigint(length(m) + length(g[i])))")
        found = f"IF(size(g) > 1, regexp_extract_all(__text, {pattern}, 0), cast(array() AS array<string>))"
        parts.append(let("g", f"split(__text, {pattern}, -1)", let("f", found, let("e", ends, kept))))
    rows = docs.withColumn("__text", F.coalesce(text, F.lit("")))
    return rows.withColumn("spans", F.expr(f"array_sort(concat({', '.join(parts)}))")).select(*[F.col(f"`{c}`") for c in own if c != "spans"], "spans")


def _of_match(test: str) -> str:
    """The test with m, before and after as fields of x."""
    import re

    return re.sub(r"(?<![\w.'])\b(m|before|after)\b(?!\w)(?!')", r"x.\1", test)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, spans) of each row; least: scores from which kinds that are no base ones are kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return spans(rows, F.col("text"), least).select("doc_id", "spans")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base kinds, the digest of base spans and all spans as text."""
    joined = "array_join(transform({x}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    count = [F.expr(f"bigint(size(filter(spans, s -> s.kind = '{k.name}')))").alias(f"n_{k.name}") for k in KINDS if k.base]
    return found.select("doc_id", *count, F.sha2(F.expr(joined.format(x="filter(spans, s -> s.base)")).cast("binary"), 256).alias("base_sha256"), F.expr(joined.format(x="spans")).alias("spans"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_personal_data(table(spark, sf_dir, "documents")))


def _oracle() -> str:
    """The same rows from positions counted by a window over gaps and matches."""
    luhn = "list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 0 THEN d[length(d) - i]::INT ELSE d[length(d) - i]::INT * 2 - CASE WHEN d[length(d) - i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
    mod97 = "list_reduce(list_transform(range(length(c)), lambda i: (c[5:] || c[:4])[i + 1]), lambda s, x: CASE WHEN x BETWEEN '0' AND '9' THEN (s * 10 + x::INT) % 97 ELSE (s * 100 + ascii(x) - 55) % 97 END, 0) = 1"
    tests = {
        "email": "true", "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda p: p::DOUBLE <= 255))", "card": f"CASE WHEN length(d) BETWEEN 14 AND 19 THEN {luhn} ELSE false END", "phone": "length(d) BETWEEN 10 AND 15",
        "iban": f"CASE WHEN length(c) BETWEEN 15 AND 34 AND regexp_matches(m, '^[A-Z][A-Z][0-9][0-9][A-Z0-9 ]+$') AND NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') THEN {mod97} ELSE false END",
        "ssn": "regexp_matches(m, '^[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}$') AND NOT regexp_matches(m, '^000|^666|-00-|-0000$') AND NOT regexp_matches(before, '[A-Za-z0-9-]$') AND NOT regexp_matches(after, '^[A-Za-z0-9-]') AND near",
        "local_phone": "NOT regexp_matches(before, '[A-Za-z0-9]$|[0-9+][ ().-]{1,3}$|[+]$') AND NOT regexp_matches(after, '^[.-]?[A-Za-z0-9]') AND near",
    }
    each = " UNION ALL ".join(
        f"SELECT r, {k} AS k, '{kind.name}' AS kind, '{kind.words}' AS words, string_split_regex(text, '{kind.plain}') AS gaps, regexp_extract_all(text, '{kind.plain}') AS found FROM docs" for k, kind in enumerate(KINDS)
    )
    keep = "CASE kind " + " ".join(f"WHEN '{name}' THEN {test}" for name, test in tests.items()) + " END"
    base = ", ".join(f"'{k.name}'" for k in KINDS if k.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)
    names = ", ".join(f"coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}" for k in KINDS if k.base)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
each AS ({each}),
found AS (SELECT r, k, kind, words, gaps, found, unnest(range(1, len(found) + 1)) AS i FROM each WHERE len(found) > 0),
placed AS (
    SELECT r, k, kind, words, found[i] AS m, gaps[i][-{LEFT}:] AS before, gaps[i + 1][:{RIGHT}] AS after,
        (sum(length(gaps[i]) + length(found[i])) OVER (PARTITION BY r, k ORDER BY i))::BIGINT AS e
    FROM found
),
judged AS (
    SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d, replace(m, ' ', '') AS c,
        regexp_matches(lower(before || ' ' || after), '(^|[^a-z])(' || words || ')([^a-z]|$)') AS near
    FROM placed
),
kept AS (SELECT r, k, kind, e - length(m) AS s, kind || ':' || (e - length(m)) || ':' || e AS span FROM judged WHERE {keep}),
joined AS (SELECT r, {counts}, string_agg(span, ',' ORDER BY s, k) FILTER (kind IN ({base})) AS base, string_agg(span, ',' ORDER BY s, k) AS spans FROM kept GROUP BY r)
SELECT doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN joined USING (r)
"""


OP13_SQL = _oracle()
