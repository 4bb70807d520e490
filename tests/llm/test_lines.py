import random

import pytest

from tickloom.llm import lines


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        cur = [i]
        for j, d in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return prev[-1]


def brute(docs):
    """doc -> [(line number, near)] of the lines that go."""
    seen, out = [], {}
    for doc, text in sorted(docs, key=lambda x: (x[0] is None, x[0] or 0)):
        for no, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\x0b\x0c\r")
            if not line:
                continue
            first = seen.index(line) if line in seen else len(seen)
            near = len(line) >= 20 and any(
                len(x) >= 20 and x != line and abs(len(x) - len(line)) < 2 and distance(x, line) == 1 for x in seen[:first]
            )
            if near or line in seen:
                out.setdefault(doc, []).append((no, near))
            seen.append(line)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_that_go_match_brute_force(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randint(15, 45))) for _ in range(12)]

    def changed(line):
        line = list(line)
        for _ in range(rng.choice([0, 0, 1, 1, 1, 2])):
            j = rng.randrange(len(line))
            line[j : j + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é", "ab"])
        return "".join(line)

    docs = [(i, "\n".join(changed(rng.choice(base)) for _ in range(rng.randint(1, 5)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "\n\n"), (None, base[0] + "\nq")]
    want = brute(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for r in lines.line_report(df).collect():
        gone = want.get(r.doc_id, [])
        assert r.dropped == ",".join(str(n) for n, _ in gone)
        assert (r.n_near, r.n_exact) == (sum(x for _, x in gone), sum(not x for _, x in gone))
    for r in lines.drop_lines(df).collect():
        text, gone = dict(docs)[r.doc_id], {n for n, _ in want.get(r.doc_id, [])}
        assert r.text == (text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = lines.line_report(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_lines_go_from_their_own_row_only(spark):
    docs = [(1, "a common line"), (None, "a common line\nx"), (None, "unique text\ny"), (2, "unique\na common line"), (2, "p\nq")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(r.text for r in lines.drop_lines(df).collect())
    assert got == sorted(["a common line", "x", "unique text\ny", "unique", "p\nq"])
