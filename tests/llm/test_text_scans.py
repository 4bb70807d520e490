"""Decontamination, licences, toxicity, personal data."""

import hashlib
import random
import re
import textwrap

import numpy as np
import pytest

from tickloom.llm import decontamination, licenses, pii, toxicity
from tickloom.llm.common import table


def part_distance(pattern, text):
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        cur = [i]
        for j, d in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return min(prev)


def test_myers_is_the_distance_to_the_best_part():
    rng = random.Random(1)
    for _ in range(300):
        p, t = ("".join(rng.choice("ab c") for _ in range(rng.randint(a, b))) for a, b in ((1, 80), (0, 120)))
        masks = {}
        for i, c in enumerate(p):
            masks[c] = masks.get(c, 0) | 1 << i
        assert decontamination.myers(masks, len(p), t) == part_distance(p, t)


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        j = rng.randrange(len(text))
        text[j : j + rng.randint(0, 1)] = rng.choice(["", "e", "aa"])
    return "".join(text)


def test_contaminated_documents_match_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    words = ["alpha", "be", "gam", "delta", "eps"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(6, 30)))) for i in range(8)]
    docs = []
    for i in range(80):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 20)))
        for _ in range(rng.randint(0, 2)):
            text += " " + edited(rng, rng.choice(items)[1], rng.randint(0, 9)).upper() + "\n more"
        docs.append((i, text))
    norm = decontamination.normalised
    want = set()
    for d, t in docs:
        for i, x in items:
            if (least := part_distance(norm(x), norm(t))) <= int(len(norm(x)) * 0.06):
                want.add((d, i, least))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for chars in (4_000_000, 200):  # one pass, and several
        monkeypatch.setattr(decontamination, "PASS_CHARS", chars)
        assert {tuple(r) for r in decontamination.contaminated(df, bench).collect()} == want
    kept = {r.doc_id for r in decontamination.clean(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _, _ in want} and want


def test_notices_are_found_and_told_apart():
    for name, text in licenses.TEMPLATES:
        found = licenses.licenses_in(f"some prose here.\n{text}\nmore prose there")
        assert [f[0] for f in found] == [name], text
        a, b = found[0][2:4]
        assert f"some prose here.\n{text}\nmore prose there"[a:b].rstrip(".:/") == text.rstrip(".:/")
    assert not licenses.licenses_in("a driving license is needed; the licensee pays")
    assert not licenses.licenses_in("Licensed under the Apache License, Version 1.1.")
    assert licenses.licenses_in("x " * 40_000 + "Released under the MIT License." + " y" * 40_000)[0][2] == 80_000
    two = licenses.licenses_in("Released under the MIT License.\nLicensed under CC BY-NC 4.0.")
    assert [x[0] for x in two] == ["MIT", "CC-BY-NC-4.0"]


@pytest.mark.parametrize("name, text", licenses.TEMPLATES)
def test_notices_are_found_in_wrapped_lines(name, text):
    for mark in ("", " * ", "# "):
        for width in (72, 40):
            wrapped = textwrap.fill(text, width, initial_indent=mark, subsequent_indent=mark)
            found = licenses.licenses_in(f"some prose here.\n\n{wrapped}\n\nmore prose there")
            assert [f[0] for f in found] == [name], wrapped


def test_every_notice_of_a_block_is_found():
    for text, sep in (("Released under the MIT License.", "\n"), ("Released under the MIT License.", " ")):
        found = licenses.licenses_in(sep.join([text] * 30))
        assert [f[0] for f in found] == ["MIT"] * 30
        assert [f[2] for f in found] == [i * (len(text) + 1) for i in range(30)]
    for templates in (licenses.TEMPLATES, licenses.TEMPLATES[::-1], licenses.TEMPLATES * 3):
        for sep in ("\n", "\n\n", " "):
            assert [f[0] for f in licenses.licenses_in(sep.join(x for _, x in templates))] == [x for x, _ in templates]


def test_notices_of_the_test_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    names = {"CC BY-NC 4.0": "CC-BY-NC-4.0", "MIT License": "MIT", "GNU General Public License, version 3": "GPL-3.0",
             "Apache License, Version 2.0": "Apache-2.0", "All rights reserved": "Proprietary"}
    want = sorted(
        (r.doc_id, names[m]) for r in docs.collect() for m in re.findall("|".join(map(re.escape, names)), r.text or "")
    )
    assert sorted((r.doc_id, r.license) for r in licenses.notices(docs).collect()) == want


def distances(term, word):
    prev = list(range(len(term) + 1))
    out = [prev[-1]]
    for i, c in enumerate(word, 1):
        cur = [i]
        for j, d in enumerate(term, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
        out.append(prev[-1])
    return out


def test_automaton_accepts_what_the_edit_distance_does():
    rng = random.Random(2)
    lengths = [(3, False), (4, True), (5, False), (6, True), (7, False), (9, False), (10, False), (8, True)]
    terms = tuple(("".join(rng.choice("abcd") for _ in range(n)), stem, float(i)) for i, (n, stem) in enumerate(lengths))
    auto, hits = toxicity.Automaton(terms), 0
    for _ in range(4000):
        word = edited(rng, rng.choice(terms)[0], rng.randint(0, 2)) + "".join(rng.choice("abc") for _ in range(rng.choice([0, 0, 3])))
        want = None
        for term, stem, weight in terms:
            every = distances(term, word)
            least = min(every) if stem else every[-1]
            if word and least <= toxicity.allowed_edits(term, stem):
                want = max(want, (least == 0, weight)) if want else (least == 0, weight)
        hits += want is not None
        assert not word or auto.match(word) == want
        assert want is None or auto.may(word[:4])
    assert hits > 500


def test_quotation_is_told_from_abuse():
    auto = toxicity.Automaton((("idiot", False, 3.0),))
    direct = toxicity.features("you are an idiot and will stay one", auto)
    quoted = toxicity.features('she said the word "idiot" is an insult', auto)
    spelled = toxicity.features("you are an idi0t", auto)
    assert direct[0] > 0 and direct[1] == 0 and quoted[0] == 0 and quoted[1] > 0 and spelled[2] > 0


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    rows = toxicity.scored(docs, labels)
    assert rows.count() == docs.count()
    known = rows.join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r.toxic for r in known]), np.array([r.predicted for r in known])
    assert (y == p).mean() > 0.97 and p[y == 1].mean() > 0.85 and p[y == 0].mean() < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in known)


def test_scores_do_not_depend_on_other_columns_or_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.scored(docs, labels).orderBy("doc_id").collect()
    b = toxicity.scored(docs.select("doc_id", "text"), other).orderBy("doc_id").collect()
    assert a == b


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        each = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in each) % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def base_spans(text):
    out = [
        (m.start(), i, m.end(), kind)
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_base_spans_match_the_plain_patterns(spark, seed):
    rng = random.Random(seed)

    def token():
        kind = rng.randrange(5)
        if kind == 0:
            return "".join(rng.choice("ab1._%+-@@..") for _ in range(rng.randint(1, 14)))
        if kind == 1:
            return ".".join(str(rng.choice([0, 9, 25, 255, 256, "007", 1000])) for _ in range(rng.randint(1, 9)))
        if kind == 2:
            return "".join(rng.choice("0123456789 -") for _ in range(rng.randint(1, 26)))
        if kind == 3:
            return "+" + "".join(rng.choice("0123456789 ().-+") for _ in range(rng.randint(1, 20)))
        return rng.choice(["é", "\n", "x", "😀", "4539578763621486", "4539 5787 6362 1486", "a@b.co", "+1 (988) 555-2485"])

    docs = [(i, rng.choice(["", " "]).join(token() for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    docs += [(9001, None), (9002, "1" * 30_000), (9003, "a." * 20_000 + "@" + "b." * 20_000), (9004, "1 " * 30_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    texts = dict(docs)
    for r in pii.spans_by_document(df).collect():
        want = base_spans(texts[r.doc_id])
        assert ",".join(x for x in r.spans.split(",") if x.split(":")[0] in PATTERNS) == want
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(f"{k}:") for k in PATTERNS]


def test_secrets_are_added(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    true = found = both = 0
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    for r in pii.spans_by_document(docs).collect():
        want = {m.span(1) for m in re.finditer(r'(?:password=|token = ")?((?<=password=)[0-9a-f]+|(?<=token = ")[0-9a-f]+|AKIA[0-9A-Z]{16})', texts[r.doc_id])}
        got = {tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("secret")}
        true, found, both = true + len(want), found + len(got), both + len(want & got)
    assert both >= 0.95 * true and both >= 0.9 * found and true > 100


def test_pii_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "password=b7db7aa4a5fcc78305 a@b.co")], "doc_id long, text string")
    plan = pii.spans_by_document(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
