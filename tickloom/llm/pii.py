"""Personal data: weakly supervised spans, in DataFrame operations only.

Four base kinds follow from a pattern and a check. Six more have candidates: key-like tokens (`secret`), values of a
password or key (`password`), numbers without a plus (`telephone`), bank and identity numbers (`account`), written-out
mail addresses (`hidden_email`) and capitalised words that may name a person (`name`). For each kind a regex, a
gazetteer, a context and a shape labeler vote on a candidate, expectation-maximisation over the counts of vote patterns
estimates how reliable they are, and a classifier of the span's features is trained on the posteriors. A candidate for
which no labeler votes is not taken. Only counts of patterns, whose number the labelers and features bound, reach the
driver.
"""

from __future__ import annotations

from itertools import product
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import stage, whole

#: The kinds in the order in which spans that start together are listed.
KINDS = ["email", "ip", "card", "phone", "secret", "password", "telephone", "account", "hidden_email", "name"]
BASE = KINDS[:4]
#: Kinds whose candidates are dropped where they overlap a base span; secrets stand beside it.
APART = KINDS[5:]

#: A capitalised word of a name, and words that begin a sentence rather than a name (fixed values).
WORD = r"(?:\p{Lu}\p{Ll}++|\p{Lu}(?=['\u2019]))(?:['\u2019-]\p{Lu}\p{Ll}++)*+"
NO_NAME = "The|This|That|An|And|But|In|On|At|Of|For|From|To|By|With|Contact|Call|Ask|Dear|Hello|Hi|Email|Signed|Regards|Sincerely|Mr|Mrs|Ms|Miss|Dr|Prof"

#: Patterns of the kinds. Quantifiers are possessive, and a match does not start inside a run that it could have started
#: before: the matches are those of the plain patterns, in time linear in the text and without recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_/+])(?=[A-Za-z_/+]*+[0-9])[A-Za-z0-9_/+]{16,}+",
    "password": r"""(?<=[:=]["'\x20]{0,2})(?=[^\s"'<>,;:=])(?<=(?i:pass|password|passwd|passphrase|pwd|pin|token|secret|credential|credentials|key)["']?\x20?[:=]\x20?["']?)(?!(?=[A-Za-z_/+]*+[0-9])[A-Za-z0-9_/+]{16,}+(?![^\s"'<>,;]))[^\s"'<>,;]{4,}+""",
    "telephone": r"(?<![\w+.,/(-])(?=[(0-9])\(?[0-9]{2,6}+\)?(?:[\x20.-][0-9]{2,6}+)++(?![\w/])",
    "account": r"(?<![A-Za-z0-9-])(?:[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4})++(?:\x20?[A-Z0-9]{1,3})?+|[0-9]{3}-[0-9]{2}-[0-9]{4})(?![A-Za-z0-9-])",
    "hidden_email": r"(?<![\w.%+-])(?<!\x20dot\x20)(?<![\])}]\x20?)[A-Za-z0-9_%+-]++(?:(?:\x20dot\x20|\x20?[\[({]dot[\])}]\x20?|\.)[A-Za-z0-9_%+-]++)*+(?:\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?|\x20(?:at|AT)\x20)[A-Za-z0-9-]++(?:(?:\x20?[\[({]dot[\])}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++)++",
    "name": rf"(?=\p{{Lu}}[\p{{Ll}}'\u2019])(?<![\p{{L}}\p{{N}}_.])(?!(?:{NO_NAME})\b)(?:{WORD}(?:\x20(?:\p{{Lu}}\.\x20)?+{WORD})++|(?<=\b(?:Mr|Mrs|Ms|Miss|Dr|Prof)\.?\x20){WORD})(?!\p{{L}})",
}
#: What a text must hold for its pattern to be worth a search.
HOLDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]", "secret": "[0-9]",
         "password": r"(?i)(?:pass|pwd|pin|token|secret|credential|key)[a-z]*+[\"']?\x20?[:=]", "telephone": r"[0-9]\)?[\x20.-][0-9]",
         "account": "[A-Z]{2}[0-9]{2}|[0-9]-[0-9]{2}-[0-9]", "hidden_email": r"(?i)(?:[\[({]\x20?(?:at|@)\x20?[\])}]|\x20at\x20)",
         "name": r"\p{Lu}\p{Ll}"}

#: Words before a secret (fixed values).
GAZETTEER = r"""(?i)(?:pass(?:word|wd|phrase)?|pwd|token|secret|credentials?|bearer|auth|(?:api|access|private|secret)[ _-]?key)["'\s]*[:=]?["'\s]*$"""
#: Prefixes of keys that issuers publish, and hexadecimal digests (fixed values).
KEY_FORMS = r"^(?:A[KS]IA[0-9A-Z]{16}|[0-9a-f]{16,}|[0-9A-F]{16,}|(?:gh[pousr]|sk|pk|rk|xox[abp])_[A-Za-z0-9_]{12,})$"
#: Words before a value that belong to keys of little worth, before numbers, addresses and names (fixed values).
STRONG_KEY = r"""(?i)(?:pass(?:word|wd|phrase)?|pwd|token|secret|credentials?|(?:api|access|private)[ _-]?key)["']?\x20?[:=]\x20?["']?$"""
CALLS = r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|contact|ring|sms)\b(?:\s+(?:me|us|no|number|at|on|is))*+[\s:.]*+$"
COUNTS = r"(?i)\b(?:page|pages|order|part|model|version|serial|isbn|issn|ref|reference|invoice|ticket|date|dated|lines?|rows?|years?|between)[\s#:.]*+$"
ACCOUNTS = r"(?i)\b(?:iban|account|acct|ssn|social security|bank|passport|insurance|tax)(?:\s+(?:no|number|id|is))*+[\s#:.]*+$"
WRITES = r"(?i)\b(?:e-?mail|mail|contact|write|reach|address|me|us|to|is)[\s:]*+$"
NO_USER = ["look", "looking", "found", "is", "are", "available", "located", "meet", "arrive", "arrived", "here", "us", "me", "site", "website", "page", "online", "read", "more", "see", "stay", "be"]
DOMAINS = r"(?i)(?:com|org|net|edu|gov|io|info|co|uk|de|fr|es|it|eu|us|ca|ch|nl)$"
TITLES = r"\b(?:Mr|Mrs|Ms|Miss|Dr|Prof)\.?\x20$"
NAMING = r"(?i)\b(?:name\s+is|name\s*:|signed(?:\s+by)?|i\s+am|i'm|regards|sincerely|yours|dear|contact|patient|employee|author|written\s+by)[\s:,]*+$"
PLACES = r"(?i)\b(?:the|in|of|at|from|a|an|near|to)\s*+$"
GIVEN_NAMES = [
    "Alice", "Andrew", "Ann", "Anna", "Anthony", "Barbara", "Carlos", "Charles", "Christopher", "Claire", "Daniel", "David", "Deborah", "Donald",
    "Dorothy", "Edward", "Elizabeth", "Emily", "Emma", "Eric", "George", "Hans", "Helen", "Henry", "James", "Jane", "Jean", "Jennifer", "Jessica",
    "John", "Jose", "Joseph", "Karen", "Kevin", "Laura", "Linda", "Lisa", "Lucas", "Luis", "Margaret", "Maria", "Marie", "Mark", "Mary", "Matthew",
    "Michael", "Mohammed", "Nancy", "Olivia", "Patricia", "Paul", "Peter", "Pierre", "Richard", "Robert", "Sandra", "Sarah", "Sophie", "Steven",
    "Susan", "Thomas", "William",
]
SOCIAL = "^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
#: Characters before a span that its context is read from.
CONTEXT = 40

LABELERS = ["regex", "gazetteer", "context", "shape"]
FEATURES = ["size", "letters", "digits", "sign", "quote"]
#: Votes: no opinion, against, for.
VOTES = (-1, 0, 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
IP = rf"^{OCTET}(?:\.{OCTET}){{3}}$"


def _passes(kind: Column, found: Column) -> Column:
    """The check of the base kinds, and the number of digits of a telephone; true for the others."""
    n = F.length(_digits(found))
    return (
        F.when(kind == "ip", found.rlike(IP))
        .when(kind == "card", F.when(n.between(14, 19), _luhn(_digits(found))).otherwise(False))
        .when(kind == "phone", n.between(10, 15))
        .when(kind == "telephone", n.between(7, 15))
        .otherwise(True)
    )


def _iban(found: Column) -> Column:
    """Whether the check digits of a bank account number fit: the rearranged number is 1 modulo 97."""
    plain = F.replace(found, F.lit(" "))
    turned = F.concat(F.substring(plain, 5, 1_000_000_000), F.left(plain, F.lit(4)))
    values = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(values, F.lit(0), lambda a, x: (F.when(x > 9, a * 100).otherwise(a * 10) + x) % 97)
    return F.when(F.length(plain).between(15, 34), rest == 1).otherwise(False)


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row (a number of its own), id, and for each kind the texts between and of its matches.

    Between the matches only lengths and the last and first characters are kept.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), whole(text_col).alias("text")
    )
    text = F.col("text")
    for kind, pattern in PATTERNS.items():
        between = F.transform(
            F.split(text, pattern, -1),
            lambda gap: F.struct(
                F.length(gap).alias("chars"),
                F.right(gap, F.lit(CONTEXT)).alias("before"),
                F.substring(gap, 1, 1).alias("after"),
            ),
        )
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        rows = rows.withColumn(
            kind, F.when(text.rlike(HOLDS[kind]), F.struct(between.alias("between"), found.alias("found")))
        )
    return rows.drop("text")


def _with_gaps(texts: Column, gaps: Column) -> Column:
    """Each match with the gap before it and the first character after it, so that a row need not carry all gaps."""
    return F.transform(
        texts,
        lambda match, i: F.struct(
            match.alias("match"), F.get(gaps, i).alias("gap"), F.get(gaps, i + 1)["after"].alias("after")
        ),
    )


def located(found: DataFrame) -> DataFrame:
    """One row per match that passes its check: row, kind, start, end (code points, end exclusive), match, before, after."""
    each = []
    for kind in KINDS:
        texts, gaps = F.col(f"{kind}.found"), F.col(f"{kind}.between")
        rows = _with_gaps(texts, gaps)
        each.append(found.where(F.size(texts) > 0).select("row", F.lit(kind).alias("kind"), F.posexplode(rows).alias("at", "one")))
    spans = each[0]
    for more in each[1:]:
        spans = spans.union(more)
    spans = spans.select("row", "kind", "at", "one.match", "one.gap", F.coalesce("one.after", F.lit("")).alias("after"))
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap.chars") + F.length("match")).over(upto)
    return (
        spans.withColumn("end", end)
        .withColumn("start", F.col("end") - F.length("match"))
        .where(_passes(F.col("kind"), F.col("match")))
        .select("row", "kind", "start", "end", "match", F.col("gap.before").alias("before"), "after")
    )


def free_spans(spans: DataFrame) -> DataFrame:
    """All spans but the candidates that overlap a base span of their document, and telephones that overlap an account
    number whose check digits fit."""
    up = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.col("kind").isin(*BASE)
    firm = base | F.when(F.col("kind") == "account", _iban(F.col("match")) | F.col("match").rlike(SOCIAL)).otherwise(False)
    marked = spans.withColumns(
        {
            f"_{x}_{name}": edge
            for name, which in (("base", base), ("firm", firm))
            for x, edge in (
                ("end", F.max(F.when(which, F.col("end"))).over(up)),
                ("start", F.min(F.when(which, F.col("start"))).over(down)),
            )
        }
    )

    def met(name: str) -> Column:
        return F.coalesce(F.col(f"_end_{name}") > F.col("start"), F.lit(False)) | F.coalesce(
            F.col(f"_start_{name}") < F.col("end"), F.lit(False)
        )

    gone = (F.col("kind").isin(*APART) & met("base")) | ((F.col("kind") == "telephone") & met("firm"))
    return marked.where(~gone).select(*spans.columns)


def _votes_and_features() -> tuple[dict[str, dict[str, Column]], dict[str, dict[str, Column]]]:
    """For each kind the vote of each labeler (1 for, 0 against, -1 none) and the features of the span."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    n = F.length(match)
    digits = F.length(_digits(match))
    share = digits / n
    assigned = before.rlike(r"""[=:]\s*["']?$""")
    mixed = match.rlike("[a-z]") & match.rlike("[A-Z]")
    quoted = after.isin('"', "'")
    day = match.rlike(r"^(?:[12][0-9]{3}[. -][01]?[0-9][. -][0-3]?[0-9]|[0-3]?[0-9][. -][0-3]?[0-9][. -][12][0-9]{3})$")
    years = match.rlike(r"^(?:1[5-9]|20)[0-9]{2}[ -](?:1[5-9]|20)[0-9]{2}$")
    dialled = match.rlike(r"^(?:0|\(0?[1-9][0-9]{1,4}\)|[2-9][0-9]{2}[. -][0-9]{3}[. -][0-9]{4}$)")
    social = match.rlike(SOCIAL)
    no_number = day | years | match.rlike(IP) | match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    user, host = F.regexp_extract(match, r"^[A-Za-z0-9_%+-]+", 0), F.regexp_extract(match, r"[A-Za-z0-9-]+$", 0)
    bracket, spoken = match.rlike(r"[\[({]"), match.rlike(r"(?i)\x20at\x20.*(?:\x20dot\x20|[\[({]dot)")
    words = F.size(F.split(match, " "))
    given = F.regexp_extract(match, r"^\p{L}+", 0).isin(*GIVEN_NAMES)
    initial = match.rlike(r"\x20\p{Lu}\.\x20")
    classes = sum(match.rlike(x).cast("int") for x in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    votes = {
        "secret": [
            F.when(match.rlike(KEY_FORMS), 1).otherwise(-1),
            F.when(before.rlike(GAZETTEER), 1).otherwise(-1),
            F.when(assigned, 1).when(before.rlike(r"[\p{L},.;]\s+$"), 0).otherwise(-1),
            F.when(match.contains("/") | (share < 0.05), 0).when(share.between(0.1, 0.95), 1).otherwise(-1),
        ],
        "password": [
            F.when(match.rlike("^[A-Z]?[a-z]+[.!?]?$"), 0).when(match.rlike("[0-9]"), 1).otherwise(-1),
            F.when(before.rlike(STRONG_KEY), 1).otherwise(-1),
            F.when(before.rlike("""=\\x20?["']?$""") | quoted, 1).when(before.rlike(r":\x20$"), 0).otherwise(-1),
            F.when(classes >= 2, 1).when(classes == 1, 0),
        ],
        "telephone": [
            F.when(no_number, 0).when(dialled, 1).otherwise(-1),
            F.when(before.rlike(CALLS), 1).otherwise(-1),
            F.when(before.rlike(COUNTS), 0).otherwise(-1),
            F.when(digits.between(9, 14) & ~no_number, 1).when(digits < 8, 0).otherwise(-1),
        ],
        "account": [
            F.when(_iban(match) | social, 1).otherwise(0),
            F.when(before.rlike(ACCOUNTS), 1).otherwise(-1),
            F.when(before.rlike(COUNTS), 0).when(assigned, 1).otherwise(-1),
            F.when(match.rlike("^[0-9]") & ~social, 0).otherwise(-1),
        ],
        "hidden_email": [
            F.when(bracket | spoken, 1).otherwise(0),
            F.when(host.rlike(DOMAINS), 1).otherwise(0),
            F.when(before.rlike(WRITES), 1).otherwise(-1),
            F.when(F.lower(user).isin(*NO_USER), 0).when(match.rlike(r"^[^ ]*[0-9._]") | spoken, 1).otherwise(-1),
        ],
        "name": [
            F.when(before.rlike(TITLES), 1).otherwise(-1),
            F.when(given, 1).otherwise(-1),
            F.when(before.rlike(NAMING), 1).when(before.rlike(PLACES), 0).otherwise(-1),
            F.when(words > 4, 0).when(initial, 1).otherwise(-1),
        ],
    }
    features = {
        "secret": [
            F.when(n < 20, 0).when(n == 20, 1).when(n < 32, 2).otherwise(3),
            F.when(~match.rlike("[A-Za-z]"), 0).when(mixed, 1).when(match.rlike("^[0-9a-f]+$"), 2).when(match.rlike("^[0-9A-Z]+$"), 3).otherwise(4),
            F.floor(share * 4),
            assigned,
            quoted,
        ],
        "password": [F.least(n, F.lit(12)), classes, F.ceil(share * 3), before.rlike("""=\\x20?["']?$"""), quoted],
        "telephone": [digits, dialled, no_number, before.rlike(CALLS), before.rlike(COUNTS)],
        "account": [F.when(_iban(match), 2).when(social, 1).otherwise(0), match.rlike("^[0-9]"), assigned, before.rlike(ACCOUNTS), before.rlike(COUNTS)],
        "hidden_email": [bracket, spoken, host.rlike(DOMAINS), before.rlike(WRITES), F.lower(user).isin(*NO_USER)],
        "name": [F.when(words > 4, 2).when(initial, 1).otherwise(0), given, before.rlike(TITLES), before.rlike(NAMING), before.rlike(PLACES)],
    }
    return (
        {kind: dict(zip(LABELERS, each, strict=True)) for kind, each in votes.items()},
        {kind: dict(zip(FEATURES, each, strict=True)) for kind, each in features.items()},
    )


def with_votes(spans: DataFrame) -> DataFrame:
    """Candidates with a vote of each labeler and the features of the span, by the rules of their kind.

    A bank account number in one run is a candidate of its own kind, not a secret.
    """
    votes, features = _votes_and_features()

    def by_kind(name: str, rules: dict[str, dict[str, Column]]) -> Column:
        out = F.lit(-1)
        for kind, columns in rules.items():
            out = F.when(F.col("kind") == kind, columns[name].cast("int")).otherwise(out)
        return F.coalesce(out, F.lit(-1))

    form = F.col("match").rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$")
    account = F.when((F.col("kind") == "secret") & form, _iban(F.col("match"))).otherwise(False)
    return spans.where(~account).withColumns(
        {**{x: by_kind(x, votes) for x in LABELERS}, **{x: by_kind(x, features) for x in FEATURES}}
    )


def reliabilities(counts: dict[tuple[int, ...], float], rounds: int = 100) -> tuple[float, list[dict]]:
    """Expectation-maximisation over counts of vote patterns: the share of true candidates, and for each labeler the
    probability of each vote given the truth, {(truth, vote): p}. Starts from the majority of the votes cast."""
    post = {v: _supported(v) * (sum(x == 1 for x in v) + 0.5) / (sum(x >= 0 for x in v) + 1.0) for v in counts}
    prior, tables = 0.5, []
    for _ in range(rounds):
        total = sum(counts.values())
        prior = min(max(sum(post[v] * c for v, c in counts.items()) / total, 1e-3), 1 - 1e-3)
        tables = []
        for i in range(len(next(iter(counts)))):
            table = dict.fromkeys(product((0, 1), VOTES), 1.0)
            for v, c in counts.items():
                table[1, v[i]] += c * post[v]
                table[0, v[i]] += c * (1 - post[v])
            tables.append({(t, x): n / sum(table[t, y] for y in VOTES) for (t, x), n in table.items()})
        new = {v: _posterior(prior, tables, v) for v in counts}
        moved = max(abs(new[v] - post[v]) for v in counts)
        post = new
        if moved < 1e-9:
            break
    return prior, tables


def _supported(votes: tuple[int, ...]) -> bool:
    """Whether any labeler votes for it: without one, a candidate is not private."""
    return 1 in votes


def _posterior(prior: float, tables: list[dict], votes: tuple[int, ...]) -> float:
    if not _supported(votes):
        return 0.0
    odds = log(prior) - log(1 - prior)
    for table, x in zip(tables, votes):
        odds += log(table[1, x]) - log(table[0, x])
    return 1 / (1 + exp(-max(-30.0, min(30.0, odds))))


Model = tuple[float, list[dict[int, float]]]


def train(candidates: DataFrame) -> dict[str, Model]:
    """For each kind seen, the span classifier: a bias and the log odds of each value of each feature (naive Bayes on
    the posteriors)."""
    rows = candidates.groupBy("kind", *LABELERS, *FEATURES).count().collect()
    kinds = sorted({r["kind"] for r in rows})
    return {kind: _fitted(sorted((tuple(r)[1:] for r in rows if r["kind"] == kind))) for kind in kinds}


def _fitted(rows: list[tuple[int, ...]]) -> Model:
    """The classifier of one kind from (votes, features, count) rows."""
    k = len(LABELERS)
    counts: dict[tuple[int, ...], float] = {}
    for r in rows:
        counts[r[:k]] = counts.get(r[:k], 0.0) + r[-1]
    prior, tables = reliabilities(counts)
    sums: list[dict[int, tuple[float, float]]] = [{} for _ in FEATURES]
    true = total = 0.0
    for r in rows:
        p, c = _posterior(prior, tables, r[:k]), r[-1]
        true, total = true + p * c, total + c
        for s, value in zip(sums, r[k:-1], strict=True):
            yes, no = s.get(value, (1.0, 1.0))
            s[value] = yes + p * c, no + (1 - p) * c
    bias = log((true + 1) / (total - true + 1))
    odds = [
        {v: log(yes / (true + len(s))) - log(no / (total - true + len(s))) for v, (yes, no) in s.items()} for s in sums
    ]
    return bias, odds


def classified(candidates: DataFrame, models: dict[str, Model]) -> DataFrame:
    """The candidates that a labeler votes for and the classifier of their kind takes for private."""
    score = F.lit(-1.0)
    for kind, (bias, odds) in models.items():
        of_kind = F.lit(bias)
        for feature, table in zip(FEATURES, odds, strict=True):
            weights = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
            of_kind = of_kind + F.coalesce(F.try_element_at(weights, F.col(feature)), F.lit(0.0))
        score = F.when(F.col("kind") == kind, of_kind).otherwise(score)
    supported = F.greatest(*[F.col(x) for x in LABELERS]) == 1
    return candidates.where(supported & (score > 0))


def spans_by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id column, the number of spans of each kind, base_sha256, spans.

    Whole texts are read, null as empty. Base spans are never dropped; the other kinds are added, secrets also where
    they overlap a base span. Repeated rows come back as often as they are, null identifiers too. Other columns are not
    read. Documents without a span have empty lists; an empty table gives an empty result.
    """
    found = stage(matches(docs, id_col, text_col), "pii-matches")
    spans = stage(free_spans(located(found)), "pii-spans")
    base = F.col("kind").isin(*BASE)
    candidates = stage(with_votes(spans.where(~base)), "pii-votes")
    added = classified(candidates, train(candidates)).select("row", "kind", "start", "end")
    taken = spans.where(base).select("row", "kind", "start", "end").union(added)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = (
        taken.groupBy(F.col("row").alias("r"))
        .agg(
            *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS],
            F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("all"),
        )
    )

    def text(spans: Column) -> Column:
        return F.coalesce(
            F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit("")
        )

    base = F.filter("all", lambda s: s["kind"].isin(*BASE))
    return found.select("row", "id").join(listed, F.col("row") == F.col("r"), "left").select(
        F.col("id").alias(id_col),
        *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in KINDS],
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("all")).alias("spans"),
    )
