"""Personal data beyond the base kinds: recall and precision on planted spans, kind by kind."""

import random
import time

import pytest

from tickloom.llm import pii

FIRST = ["Mary", "John", "Ingrid", "Peter", "Zoltan", "Aisha", "Linda", "Thomas", "Priya", "Robert"]
LAST = ["Jones", "Okafor", "Lindqvist", "Nakamura", "Weber", "O'Brien", "Moreau", "Kowalski"]


def digits(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def iban(rng, spaced):
    body = "".join(rng.choice("ABCDEFGH") for _ in range(4)) + digits(rng, 14)
    number = "".join(str(int(c, 36)) for c in body + "GB00")
    text = f"GB{98 - int(number) % 97:02d}{body}"
    return " ".join(text[i : i + 4] for i in range(0, len(text), 4)) if spaced else text


def password(rng):
    return "".join(rng.choice("abcdefgh") for _ in range(6)) + digits(rng, 2) + rng.choice(["", "#x!", "$Q"])


# For each kind sentences with a span in the place of {}, spans, and sentences without any.
PLANTED = {
    "password": (
        ["login with password={} today", 'set "api_key": "{}" there', "pwd: {} works", "token = '{}' then"],
        password,
        ["password: required for all", "the secret: always wait", "token: string, optional", "key: value pairs are here"],
    ),
    "telephone": (
        ["call me on {} soon", "phone: {}.", "tel {}", "my mobile number is {} ok", "fax {}"],
        lambda r: r.choice([f"020 {digits(r, 4)} {digits(r, 4)}", f"0044 20 {digits(r, 4)} {digits(r, 4)}", f"(212) 555-{digits(r, 4)}", f"415-555-{digits(r, 4)}"]),
        ["dated 2024-03-17 here", "in the years 1990-2005 it", "see page 123-456789 there", "order 55-1234-77 came", "version 10.11.12.13 runs"],
    ),
    "account": (
        ["IBAN {} for the rent", "my account number is {}", "bank: {}.", "pay to {} please"],
        lambda r: r.choice([iban(r, True), iban(r, False), f"{r.randint(100, 665)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"]),
        ["part 999-12-3456 is sold", "order 000-11-2222 came", "code AB12 CDEF GHIJ KLMN again", "model 666-10-1000"],
    ),
    "hidden_email": (
        ["write to {} please", "contact {}", "mail me: {}.", "my address is {} for now"],
        lambda r: r.choice(["{}.{} [at] {} [dot] com", "{} dot {} at {} dot org", "{}{} (at) {}.net", "{}_{} at {} dot de"]).format(
            r.choice(FIRST).lower(), digits(r, 2), r.choice(["mail", "posteo", "example"])),
        ["look at example.com for it", "available at shop.example.org now", "meet at noon.Then go", "found at data.gov today"],
    ),
    "name": (
        ["my name is {} and", "signed by {}.", "Dr. {} left", "regards, {}", "the patient {} slept", "Mrs. {} came"],
        lambda r: f"{r.choice(FIRST)} {r.choice(['', 'J. '])}{r.choice(LAST)}",
        ["in New York and", "the Supreme Court ruled", "we saw Old Town Square twice", "from Green Valley to", "a Grand Canal tour"],
    ),
}


@pytest.fixture(scope="module")
def planted():
    """Texts and the spans planted in them, as (kind, start, end)."""
    rng = random.Random(7)
    texts, spans = {}, {}
    for i in range(1200):
        text, found = "", set()
        for _ in range(rng.randint(0, 3)):
            kind = rng.choice(list(PLANTED))
            frames, make, plain = PLANTED[kind]
            if rng.random() < 0.5:
                before, after = rng.choice(frames).split("{}")
                span = make(rng)
                found.add((kind, len(text + before), len(text + before + span)))
                text += before + span + after
            else:
                text += rng.choice(plain)
            text += rng.choice(["\n", " é; ", ", 😀 then, "])
        texts[i], spans[i] = text, found
    return texts, spans


def taken(row):
    return {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in row.spans.split(",") if x)}


def test_planted_spans_are_found(spark, planted):
    texts, spans = planted
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: taken(r) for r in pii.spans_by_document(df).collect()}
    assert len(got) == len(texts)
    report = {}
    for kind in PLANTED:
        want = {(i, s) for i in texts for s in spans[i] if s[0] == kind}
        have = {(i, s) for i in texts for s in got[i] if s[0] == kind}
        report[kind] = (len(want & have) / len(want), len(want & have) / max(1, len(have)), sorted(
            (texts[i][max(0, s[1] - 20):s[2]], s in spans[i]) for i, s in want ^ have)[:8])
    weak = {kind: x for kind, x in report.items() if min(x[:2]) < 0.9}
    assert not weak


def test_candidates_do_not_overlap_base_spans(spark):
    texts = ["+1 (771) 555-1655", "4539 5787 6362 1486", "10.20.30.40", "x@y.org at z.com", "+44 20 7946 0958 and 020 7946 0958"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.spans_by_document(df).collect():
        spans = sorted(taken(r), key=lambda s: s[1:])
        base = [s for s in spans if s[0] in pii.BASE]
        assert base
        for kind, a, b in spans:
            assert kind in pii.BASE or kind == "secret" or all(b <= x or a >= y for _, x, y in base)


def test_a_candidate_without_a_vote_is_not_taken(spark):
    df = spark.createDataFrame([(i, f"we saw Old Town {x} and Blue Hill") for i, x in enumerate("ABCDEFGH")], "doc_id long, text string")
    assert all(r.spans == "" for r in pii.spans_by_document(df).collect())
    prior, tables = pii.reliabilities({(-1, -1, -1, -1): 50.0, (1, 1, -1, 1): 5.0})
    assert pii._posterior(prior, tables, (-1, -1, -1, -1)) == 0.0 and pii._posterior(prior, tables, (1, 1, -1, 1)) > 0.5


LONG = [
    "Aa " * 8_000, "a dot " * 8_000, "a@b at " * 8_000, "12 " * 8_000, "AB12 " * 8_000, "key=" * 8_000, "pass: " * 8_000, "(" * 9_000,
    "0-" * 9_000, "x [dot] " * 8_000, "Mr. Aa. " * 8_000, "Ann Lee. " * 8_000, "pwd=ab12; " * 8_000,
]


def test_long_texts_take_linear_time(spark):
    def seconds(times):
        df = spark.createDataFrame([(i, text * times) for i, text in enumerate(LONG)], "doc_id long, text string")
        start = time.time()
        assert pii.spans_by_document(df.repartition(4)).count() == len(LONG)
        return time.time() - start

    first = seconds(1)
    assert seconds(4) < 10 * first + 10
