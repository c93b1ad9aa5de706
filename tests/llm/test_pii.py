"""Personal data: fixed patterns against plain regular expressions, and planted contexts."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lingmill.llm import pii


def plain_spans(text):
    """The contract read literally."""
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    def luhn(d):
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0

    email = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ip = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    card = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    phone = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    return {
        "email": [m.span() for m in email],
        "ip": [m.span() for m in ip if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in card if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in phone if 9 <= len(digits(m)) <= 15],
    }


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-+ 0125()%é٣\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([
    "4111 1111 1111 1111", "4111-1111-1111-1112", "a.b@c.de", "@x.y@z.w", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.0.00.1",
    "+1 (555) 010-9999", "+12", "++1 2345 678 9", "4" * 13, "q@q", ".", "日本", "0" * 16, "a@b.c@d.e",
]), max_size=8), st.sampled_from(["", " ", ".", "-"]))
def test_base_spans_of_joined_identifiers(parts, glue):
    text = glue.join(parts)
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1(" * 100_000, "@a" * 100_000, "1 " * 200_000):
        spans = pii.base_spans(text)
        assert not spans["phone"] and len(pii.other_instances(text, [])) <= 200_000


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS spans", "1 AS value", "2 AS kind", "3 AS base")
    made = pii.find(df.repartition(4))
    assert made.columns == ["doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256", "spans", "n_found"]
    return sorted(map(tuple, made.collect()), key=repr)


def base_row(doc_id, text):
    base = plain_spans(text or "")
    joined = ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in base[k])
    return (doc_id, *(len(base[k]) for k in pii.KINDS), hashlib.sha256(joined.encode()).hexdigest(), joined, 0)


def test_odd_rows(spark):
    texts = [
        (1, "write to a.b@c.de, +1 (555) 010-9999"), (1, "write to a.b@c.de, +1 (555) 010-9999"), (1, "other 10.0.0.1"),
        (None, "x@y.zz"), (None, None), (2, None), (3, ""), (4, "é日本 4111 1111 1111 1111 é"), (5, "p" * 200 + "@long.example.com"),
        (6, "word " * 50_000 + "10.2.3.4"), (7, "99.99.99.999 4111-1111-1111-1112"), (7, "   \n"),
    ]
    assert found(spark, texts) == sorted((base_row(*r) for r in texts), key=repr)
    assert found(spark, []) == []


def number(rng, form):
    return re.sub("9", lambda _: str(int(rng.integers(0, 10))), form)


def planted(rng):
    """Seeds after "reach me at", unseen forms in the same place, and a second context that
    only the unseen ones lead to."""
    rows, unseen = [], []
    for i in range(200):
        rows.append((i, f"w{'abcd'[i % 4]} reach me at {number(rng, '+1 (999) 999-9999')} today"))
    for i in range(60):
        value = number(rng, "999 555 9999")
        for at, lead in ((1000, "reach me at"), (2000, "hotline is")):
            rows.append((at + i, f"please {lead} {value} or so"))
            unseen.append((at + i, f"phone:{7 + len(lead) + 1}:{7 + len(lead) + 1 + len(value)}"))
    for i in range(3):
        value = number(rng, "888999999")
        rows.append((3000 + i, f"the hotline is {value} or so"))
        unseen.append((3000 + i, f"phone:15:{15 + len(value)}"))
    # Numbers of the same look beside words that tell nothing.
    clean = [(4000 + i, f"order no {number(rng, '999 555 9999')} shipped in {number(rng, '2099')}") for i in range(300)]
    return rows, clean, dict(unseen)


def test_contexts_lead_to_unseen_identifiers(spark):
    rows, clean, unseen = planted(np.random.default_rng(1))
    got = {r[0]: r for r in found(spark, rows + clean)}
    assert {d: got[d][6] for d in unseen} == unseen
    assert all(got[d][7] == 1 for d in unseen)
    for doc_id, text in rows[:200] + clean:
        assert got[doc_id] == base_row(doc_id, text)


def test_copies_do_not_make_a_pattern_trusted(spark):
    """One text a thousand times vouches for no more than once."""
    seed = "reach me at +1 (555) 010-9999 today"
    rows = [(i, seed) for i in range(1000)] + [(2000, "reach me at 555 010 1111 today")]
    got = {r[0]: r for r in found(spark, rows)}
    assert got[2000][7] == 0 and got[5] == base_row(5, seed)


def test_a_word_that_stands_beside_anything_is_not_trusted(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"at {number(rng, '+1 (999) 999-9999')}") for i in range(100)]
    rows += [(1000 + i, f"at {number(rng, '999 9999 99')}") for i in range(100)]
    assert all(r[7] == 0 for r in found(spark, rows))
