"""Fill-in-middle, SentencePiece spans and cross-tokenizer alignment, against brute force and the libraries."""

import hashlib
import json
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.llm import align, fim, pieces

ODD = ["", " ", "\n", "a", "a\n", "\n\n", "   a  b ", "日本語 🙂 ▁x", "<s></s><|endoftext|>", "é́ﬁ", "a\0b", "x" * 3000, " " * 3000,
       "🙂" * 50, "one\ntwo\r\nthree four\n", "<P> here", "a<M>", "<", "ＡＢＣ ①②　㌔"]


def noise(seed, n, alphabet="ab c\n\n.éß🙂<P>SM▁07"):
    r = random.Random(seed)
    return "".join(r.choice(alphabet) for _ in range(n))


# ---------------------------------------------------------------- fill-in-middle


def plain_fim(doc_id, text, seed=7, share=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= share:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts_for_fim():
    shared = "\n".join(noise(i, 40, "abc dé") for i in range(200))
    out = [*ODD, *[noise(i, 50 + 37 * i, "ab c\n.éß🙂<7") for i in range(40)], *[noise(i, 3, "<PSM>\n") for i in range(60)]]
    out += [noise(i, 90 * i, "abc é") + shared + noise(i + 1, 200, "xy\n") for i in range(10)]
    out += ["z" * n + "<S>" + "y" * 100 for n in range(55, 70)]  # marks on both sides of a chunk's first end
    return out


@pytest.mark.parametrize(("share", "spm", "seed"), [(100, 50, 7), (60, 0, 1), (0, 100, 7)])
def test_fim_is_what_cutting_into_lines_gives(spark, share, spm, seed):
    rows = [(i, t) for i, t in enumerate(texts_for_fim())] + [(None, None), (None, "x\ny\n"), (3, "again\nand\nagain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = fim.fill_in_middle(docs, seed, share, spm)
    got = made.withColumn("back", fim.restored("output", "form")).collect()
    assert [(r.doc_id, r.text) for r in got] == rows
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.doc_id, r.text or "", seed, share, spm)
        assert r.back == (r.text or "")


def test_chunks_depend_on_content_and_cover_the_text():
    shared = noise(1, 30_000, "abcdef \n").encode()
    first, second = b"x" * 700 + shared, noise(2, 5_001, "gh i\n").encode() + shared
    cut = [{d[a:b] for a, b in zip([0, *ends], ends, strict=False)} for d in (first, second) for ends in [fim.chunk_ends(d)]]
    assert sum(map(len, cut[0] & cut[1])) > 0.9 * len(shared)
    for data in (first, b"", b"a" * 64, b"a" * 65, b"q" * 3_000_000):
        ends = fim.chunk_ends(data)
        sizes = np.diff([0, *ends])
        assert sum(sizes) == len(data) and (len(sizes) == 0 or sizes.max() <= fim.MOST)


def test_rolling_hash_is_that_of_the_last_bytes(monkeypatch):
    data = noise(5, 400).encode()
    table = fim._gear()
    want = [sum(int(table[b]) << k for k, b in enumerate(reversed(data[max(0, i - 31) : i + 1]))) % 2**32 for i in range(len(data))]
    assert fim.rolling(np.frombuffer(data, np.uint8)).tolist() == want
    whole = fim.chunk_ends(data * 50)
    monkeypatch.setattr(fim, "BLOCK", 1000)
    assert fim.chunk_ends(data * 50) == whole


def test_remembered_chunks_are_compared_before_they_are_believed(monkeypatch):
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda content: 1)
    memory = fim.Memory()
    for content in (b"a\nb", b"a\nbc\n", b"a\nb"):
        assert memory(content) == fim.summary(content)
    memory(b"a\nb")
    assert memory.hits == 1


def test_memory_is_bounded_and_forgetting_changes_nothing():
    small, large = fim.Memory(2_000), fim.Memory()
    for i in range(300):
        data = noise(i % 40, 900).encode()
        assert fim.transformed(data, str(i), 7, 100, 50, small) == fim.transformed(data, str(i), 7, 100, 50, large)
    assert len(small.new) + len(small.old) < len(large.new) and large.hits > 0


# ---------------------------------------------------------------- pieces


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.tokenizer_path(pieces.MODEL))


def spans(model, text):
    ids, begins, ends = model.encode(text.encode())
    return list(zip(ids.tolist(), begins.tolist(), ends.tolist(), strict=True))


def library_spans(library, text):
    return [(p.id, p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc", "nfkc_cf", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("dummy", [True, False])
def test_ids_and_spans_are_the_librarys(rule, squeeze, dummy):
    """Under every public character map, put into the given model."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    made = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=squeeze
    )
    spec, given_model = proto.ModelProto(), proto.ModelProto()
    spec.ParseFromString(made.serialized_model_proto())
    given_model.ParseFromString(Path(pieces.tokenizer_path(pieces.MODEL)).read_bytes())
    given_model.normalizer_spec.CopyFrom(spec.normalizer_spec)
    raw = given_model.SerializeToString()
    own, library = pieces.Pieces(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    for text in [*ODD, *[noise(i, 5 * i, "ab  \nßéﬁ①㌔Ａ　́🙂<0x>▁") for i in range(60)]]:
        assert spans(own, text) == library_spans(library, text), text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text_comes_back(text):
    model = pieces.pieces()
    found = spans(model, text)
    data = text.encode()
    assert b"".join(data[b:e] for _, b, e in found) == data
    assert [x for x, _, _ in found] == model.ids(data).tolist()


def test_bytes_that_are_no_text_become_replacement_characters():
    model = pieces.pieces()
    text, source = model.normalise(b"a\xffb \xc3")
    assert text == "▁a�b▁�"
    assert source.tolist() == [0, 0, 0, 0, 1, 1, 1, 2, 3, 3, 3, 4, 4, 4, 5]


def test_report_against_the_library(spark, library):
    texts = [*ODD, None, *[noise(i, 300) for i in range(20)], noise(1, 200_000, "ab cde\n")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pieces.pieces_report(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids) if ids else "")]
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), *sha)
        assert got[i].covered_bytes == len((text or "").encode())


# ---------------------------------------------------------------- alignment


def test_merging_by_rank_is_merging_by_listed_pairs():
    """Each entry's own merge is what the lower ranks leave of it: the last step is then the listed one."""
    level = align.byte_level()
    spec = json.loads(Path(align.tokenizer_path(align.TOKENIZER)).read_text())["model"]["merges"]
    alphabet = align.byte_of_character()
    ranks = {b: i for i, b in enumerate(level.bytes) if b}
    for rank, merge in enumerate(spec, 256):
        left, right = (bytes(alphabet[c] for c in x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
        parts = [bytes([b]) for b in left + right]
        while True:
            pairs = [(ranks[p + q], i) for i, (p, q) in enumerate(zip(parts, parts[1:], strict=False)) if ranks.get(p + q, rank) < rank]
            if not pairs:
                break
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert parts == [left, right]


def test_ids_are_those_of_the_tokenizer_file():
    level = align.byte_level()
    texts = [*ODD, *[noise(i, 200) for i in range(200)], "y" * 2000 + " z", " " * 700 + "z", "<|endoftext|>"]
    texts += [f"a{chr(c)}b {chr(c)}1 {chr(c)}" for c in range(0, 0x30000, 61) if not 0xD800 <= c < 0xE000]
    want = level.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [level.encode(x) for x in texts] == [w.ids for w in want]
    assert [level.by_rank.encode_ordinary(x) for x in texts] == [w.ids for w in want]


ENDS = st.lists(st.integers(1, 400), min_size=1, max_size=120, unique=True)


@settings(max_examples=300, deadline=None)
@given(ENDS, ENDS, st.integers(0, 300))
def test_groups_end_where_both_end(a, b, alike):
    a, b = {*a, *range(1, alike), 401}, {*b, *range(1, alike), 401}
    cuts = align.diagonal_groups(np.array(sorted(a)), np.array(sorted(b)))
    common = sorted(a & b)
    assert [sorted(s)[c - 1] for s, c in zip([a] * len(common), cuts[0], strict=True)] == common
    assert [sorted(s)[c - 1] for s, c in zip([b] * len(common), cuts[1], strict=True)] == common


def brute_alignment(texts):
    """Per text: n_a, n_b, n_groups, n_links, groups_sha256 and its links, token by token."""
    level, model, out = align.byte_level(), pieces.pieces(), []
    for text in texts:
        spaced = b" " + (text or "").encode()
        a = level.tokenizer.encode(spaced.decode(), add_special_tokens=False).ids
        b = model.library.encode(model.normalise((text or "").encode())[0])
        if not text or any(b"".join(v.bytes[i] for i in ids) != spaced for v, ids in ((level, a), (model, b))):
            out.append(((0, 0, 0, 0, ""), []))
            continue
        ends = [[sum(len(v.bytes[i]) for i in ids[: k + 1]) for k in range(len(ids))] for v, ids in ((level, a), (model, b))]
        links = [(x, y) for x, e in zip(a, ends[0], strict=True) for y, f in zip(b, ends[1], strict=True) if e == f]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        out.append(((len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()), links))
    return out


@pytest.mark.parametrize("broadcast_pairs", [10**6, 0])
def test_alignment_report_against_brute_force(spark, broadcast_pairs):
    texts = [*ODD[:11], None, *ODD[13:], *[noise(i, 200, "ab cde\n.é7") for i in range(30)], "the end", "the end", "the end", "▁"]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = brute_alignment(texts)
    counts = Counter(link for _, links in rows for link in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    want = []
    for i, ((n_a, n_b, n_groups, n_links, digest), links) in enumerate(rows):
        best = sum(counts[x] == most[x[1]] for x in links)
        want.append((i // 2, n_a, n_b, n_groups, n_links, best, sum(counts[x] for x in links), digest))
    got = align.alignment_report(docs, broadcast_pairs=broadcast_pairs).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert sum(r.n_groups for r in got) > 1000


def test_groups_of_documents(spark):
    docs = spark.createDataFrame([(1, "the quick brown"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in align.with_groups(docs).collect()}
    level, model = align.byte_level(), pieces.pieces()
    r = got[1]
    for i, (end_a, end_b) in enumerate(zip(r.a_cuts, r.b_cuts, strict=True)):
        begin_a, begin_b = (r.a_cuts[i - 1], r.b_cuts[i - 1]) if i else (0, 0)
        a, b = (b"".join(v.bytes[x] for x in ids) for v, ids in ((level, r.a_ids[begin_a:end_a]), (model, r.b_ids[begin_b:end_b])))
        assert a == b
    assert [list(got[i][1:]) for i in (2, 3)] == [[None, [], [], [], []], ["", [], [], [], []]]


# ---------------------------------------------------------------- awkward and empty tables

REPORTS = {"fim": fim.fim_report, "pieces": pieces.pieces_report, "alignment": align.alignment_report}
COLUMNS = {"fim": fim.fill_in_middle, "pieces": pieces.with_pieces, "groups": align.with_groups}


@pytest.mark.parametrize("name", REPORTS)
def test_awkward_rows_all_come_back(name, awkward, empty):
    assert REPORTS[name](awkward).count() == awkward.count()
    assert REPORTS[name](empty).collect() == []


@pytest.mark.parametrize("name", COLUMNS)
def test_clashing_columns_keep_their_values(name, awkward, empty):
    clash = awkward.withColumns({c: F.lit("kept as it is") for c in ("n", "form", "Output", "ids", "ends", "a_ids", "b_cuts")})
    out = COLUMNS[name](clash)
    assert out.columns[: len(clash.columns)] == clash.columns
    for c in ("weight", "n", "Output", "ids", "a_ids"):
        assert out.where(F.col(c) == "kept as it is").count() == awkward.count()
    assert COLUMNS[name](empty).collect() == []
