"""Personal data: base spans against the expressions as they are written in the contract, checks
of numbers, context, and masks."""

import random
import re

import pytest

from tableferry.llm import pii

SCHEMA = "doc_id long, text string, Spans string, kind string"
WRITTEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    """By the expressions, each match checked by itself."""
    def good(kind, m):
        digits = [int(c) for c in re.findall("[0-9]", m)]
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15
    found = [(k, *m.span()) for k in WRITTEN for m in re.finditer(WRITTEN[k], text) if good(k, m.group())]
    return sorted(found, key=lambda s: (s[1], list(WRITTEN).index(s[0])))


def with_check(digits):
    return next(digits + str(c) for c in range(10) if pii.luhn(digits + str(c)))


def test_base_spans_are_those_of_the_expressions():
    rng = random.Random(7)
    pieces = ["a@b.c", "a@b", "@b.c", ".c@d.e", "%", "1.2.3.4", "999.1.1.1.2.2.2", "0255.1.1.001", "4111 1111 1111 1111",
              "4111-1111-1111-1112", "+1 (017) 555-7713", "+49.30.1234567", "+", "12", " ", "-", ".", "(", ")", "é", "\n", "@",
              "5500005555555559", "1 2", "x" * 30, "+1+22 333 444 555"]
    for n in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain(text), text
    for n in range(2000):
        text = "".join(rng.choice("01289 -.+@a()") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "a." * 150_000, "1" * 300_000, "1 " * 150_000, "1." * 150_000, "+1" * 150_000,
                                  "+1" + "(" * 300_000, "a@" * 150_000, "a@b." * 80_000, "DE12 " * 60_000, "A" * 300_000,
                                  "a@b.c " * 60_000, "(030) 123 4567 " * 20_000, "4111111111111111 tel " * 15_000])
def test_time_grows_with_the_length(text):
    pii.Finder().spans(text)


def test_checks():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod_97("DE89370400440532013000") and not pii.mod_97("DE89370400440532013001")
    assert pii.mod_97("GB82WEST12345698765432")


def kinds(text):
    return [(k, text[a:b]) for k, a, b, _ in pii.Finder().spans(text)]


def test_further_kinds_need_their_check_or_their_context():
    assert kinds("an DE89 3704 0044 0532 0130 00 OK") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("an DE89 3704 0044 0532 0130 01 OK") == []
    assert kinds("SSN: 123-45-6789.") == [("national_id", "123-45-6789")]
    assert kinds("part 123-45-6789.") == [] and kinds("ssn 666-45-6789") == []
    assert kinds("Tel. (030) 123 4567") == [("local_phone", "(030) 123 4567")]
    assert kinds("see (030) 123 4567") == [] and kinds("call order 030 123 4567") == []
    # a base span keeps its place
    assert kinds("phone +1 (017) 555-7713") == [("phone", "+1 (017) 555-7713")]


def test_score_follows_context():
    finder = pii.Finder()
    score = {t: finder.spans(t)[0][3] for t in ("4111111111111111", "visa 4111111111111111",
                                                "invoice 4111111111111111")}
    assert score["invoice 4111111111111111"] < score["4111111111111111"] < score["visa 4111111111111111"]


def test_masks():
    text = "é me@x.org or +1 (017) 555-7713!"
    assert pii.masked(text, pii.Finder().spans(text)) == "é <EMAIL> or <PHONE>!"
    assert pii.masked("abcdef", [("card", 1, 4, 1.0), ("phone", 2, 5, 1.0)]) == "a<CARD>f"


def test_table(spark):
    texts = [None, "", "a@b.c", "a@b.c", "x 👩‍👩‍👧 1.2.3.4 " * 4000, " \t\n", "IP 1.2.3.4, 4111111111111111"]
    docs = spark.createDataFrame([(i, t, "old", "clash") for i, t in enumerate(texts)] + [(None, "a@b.c", "", "")], SCHEMA)
    got = pii.found(docs, mask="masked").select("doc_id", "text", "kind", "masked", "spans",
                                                 pii.listed(pii.F.col("spans")).alias("listed")).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        want = plain(r.text or "")
        assert r.listed == ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert "@" not in r.masked and r.kind in ("clash", "")
    assert pii.found(docs.limit(0)).collect() == []


def test_query_counts_base_spans_and_keeps_them(spark, sf_dir):
    from tableferry.llm.queries import QUERIES
    from tableferry.sources.tables import table
    import hashlib
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    got = QUERIES["op13_personal_data"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        shown = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[0] == k for s in want) for k in WRITTEN]
        assert set(shown) <= set(r.spans.split(",")) | {""}
