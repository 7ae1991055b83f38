import hashlib
import random
import re

from llm_cases import ODD, documents

from tamarack.llm.personal_data import KINDS, digest, find_personal_data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORKING_CARD, BROKEN_CARD = "4111 1111 1111 1111", "4111 1111 1111 1112"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def fits(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if fits(kind, m.group())]
    return [x[2] for x in sorted(found)]


def rows(spark, texts, **k):
    return {r.doc_id: r for r in digest(find_personal_data(documents(spark, texts, **k))).collect()}


def expected(texts):
    return {i: hashlib.sha256(",".join(plain(t)).encode()).hexdigest() for i, t in enumerate(texts)}


def test_base_spans_are_those_of_a_plain_search(spark):
    rng = random.Random(5)
    alphabet = ["a", "b.c", "@", "@x.y", ".", "-", "+", "%", "_", "1", "25", "255", "256", " ", "(", ")", "\n", "é", "日", "😀", "4111111111111111", "+1 (555) 123-4567", "10.0.0.1", "a@b.c"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(800)]
    texts += [None, *ODD, "a@b.c_d@e.f", "x@y@z.w", "1.2.3.4.5.6.7.8.9", "000001.2.3.4", "a@b", WORKING_CARD, BROKEN_CARD, f"{WORKING_CARD} {WORKING_CARD}", "+12345678901 +123456789", "9" * 400 + ".1.1.1"]
    got = rows(spark, texts)
    assert {i: r.base_sha256 for i, r in got.items()} == expected(texts)
    for i, text in enumerate(texts):
        found = plain(text)
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(x.startswith(k + ":") for x in found) for k in BASE]
        assert set(found) <= set(got[i].spans.split(",")) or not found


def test_checksums_and_words_decide_further_kinds(spark):
    texts = ["pay to iban DE89 3704 0044 0532 0130 00 now", "pay to DE89370400440532013000", "pay to DE88370400440532013000", "order 078-05-1120", "her SSN is 078-05-1120.", "ssn 000-05-1120", "call (212) 555-0188 today", "part 212 555-0188", "call +1 (212) 555-0188"]
    spans = {i: r.spans for i, r in rows(spark, texts).items()}
    assert spans[0] == "iban:12:39" and spans[1] == "iban:7:29" and spans[2] == ""
    assert (spans[3], spans[4], spans[5]) == ("", "ssn:11:22", "")
    assert (spans[6], spans[7], spans[8]) == ("local_phone:5:19", "", "phone:5:22")


def test_scores_rise_with_a_word_nearby(spark):
    found = find_personal_data(documents(spark, [f"visa {WORKING_CARD}", f"lot {WORKING_CARD}"])).collect()
    near, far = [{r.doc_id: r.spans[0].score for r in found}[i] for i in (0, 1)]
    assert near > far
    strict = find_personal_data(documents(spark, ["call (212) 555-0188"]), least={"local_phone": 0.9}).collect()
    assert strict[0].spans == []


def test_long_texts_take_time_in_proportion(spark):
    texts = ["a" * 2_000_000, "1" * 2_000_000, "a.b" * 500_000, "a@b" + ".c" * 500_000, "1." * 700_000, (WORKING_CARD + "\n") * 20_000, "+1" * 400_000, "x@" * 400_000]
    got = rows(spark, texts)
    assert (got[3].n_email, got[5].n_card, got[4].n_ip, got[0].spans) == (1, 20_000, 175_000, "")  # a plain search is quadratic here
    assert got[5].base_sha256 == expected([texts[5]])[0]


def test_odd_tables(spark):
    df = documents(spark, ["a@b.c", "a@b.c", None], ids=[1, 1, None])
    got = sorted(digest(find_personal_data(df)).collect(), key=str)
    assert [(r.doc_id, r.n_email) for r in got] == [(1, 1), (1, 1), (None, 0)]
    assert find_personal_data(df.where("false")).count() == 0
    clashing = df.withColumn("spans", df.text).withColumn("__text", df.text)
    assert find_personal_data(clashing).columns == ["doc_id", "spans"]
    assert [k.name for k in KINDS if k.base] == list(BASE)


def test_no_shuffle_and_no_python(spark):
    plan = digest(find_personal_data(documents(spark, ["a"])))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
