"""Line dedup by deletion neighbourhoods, in DataFrame operations only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import apart, stage, whole

#: Lines shorter than this are dropped as exact copies only: one edit would change too much of them.
NEAR_CHARS = 20
#: Pieces of a line, one of which holds the edit.
PIECES = 8

_LINE = ["h1", "h2"]
_TEXT = ["t1", "t2"]


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line that is not blank: id, no, at (its place in the order of the corpus), h1, h2, line, t1, t2 (its text).

    Lines are compared without the white space around them. Places order by identifier, then line number.
    """
    lines = F.posexplode(F.split(whole(text_col), "\n", -1))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *_text_keys(whole(text_col)), lines)
    rows = rows.toDF("id", *_TEXT, "no", "line").withColumn("line", F.btrim("line", F.lit(" \t\x0b\x0c\r")))
    order = F.coalesce(F.col("id").cast("decimal(20,0)"), F.lit(Decimal(2**63)))
    place = order * F.lit(Decimal(2**31)) + F.col("no")
    return rows.where(F.col("line") != "").select(
        "id",
        "no",
        place.cast("decimal(38,0)").alias("at"),
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit("second"), "line").alias("h2"),
        "line",
        *_TEXT,
    )


def _text_keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]


def _head(line: Column, n: Column) -> Column:
    return F.substring(line, F.lit(1), n)


def _tail(line: Column, chars: Column, n: Column) -> Column:
    return F.substring(line, chars - n + 1, n)


def _halves(line: Column) -> Column:
    """Keys of which two lines within one edit share one.

    With m characters in the shorter line, either the first or the last m/2 are the same in both. A line takes part as
    the shorter one (m = its length) and as the longer one (m = its length - 1).
    """
    chars = F.length(line)
    keys = []
    for m in (chars, chars - 1):
        half = F.floor(m / 2).cast("int")
        keys.append(F.xxhash64(F.lit("head"), m, _head(line, half)))
        keys.append(F.xxhash64(F.lit("tail"), m, _tail(line, chars, half)))
    return F.array(*keys)


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key is that of two different lines at least."""
    keys = rows.groupBy(key).agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select(key)
    return rows.join(keys, key, "left_semi")


def _windows(lines: DataFrame) -> DataFrame:
    """For each piece that may hold the edit: the key of all that lies around it, and the window text itself."""
    line, chars = F.col("line"), F.length("line")

    def window(m: Column, i: Column, longer: bool) -> Column:
        a = F.floor(m * i / PIECES).cast("int")
        rest = m - F.floor(m * (i + 1) / PIECES).cast("int")
        around = F.xxhash64(m, i, _head(line, a), _tail(line, chars, rest))
        return F.struct(
            around.alias("around"), F.substring(line, a + 1, chars - rest - a).alias("window"), F.lit(longer).alias("longer")
        )

    pieces = F.array(*[F.lit(i) for i in range(PIECES)])
    both = F.concat(
        F.transform(pieces, lambda i: window(chars, i, False)), F.transform(pieces, lambda i: window(chars - 1, i, True))
    )
    return lines.select("at", *_LINE, F.explode(both).alias("w")).select("at", *_LINE, "w.*")


def _variants(windows: DataFrame) -> DataFrame:
    """All variants of a window within one deletion, as hashed keys.

    Of two lines of equal length, one substitution apart, both lose the same position: those variants are keyed with
    the position, and any two lines of such a group are within the bound. Of two lines one insertion apart, the longer
    loses a character and the shorter loses none.
    """
    window, around = F.col("window"), F.col("around")
    places = F.sequence(F.lit(1), F.length(window))
    without = lambda p: F.concat(F.substring(window, F.lit(1), p - 1), F.substring(window, p + 1, F.length(window)))

    def key(kind: str, p: Column, text: Column, role: int) -> Column:
        parts = [F.lit(kind), around, p, text]
        return F.struct(
            F.xxhash64(*parts).alias("g1"), F.xxhash64(F.lit("second"), *parts).alias("g2"), F.lit(role).alias("role")
        )

    none = F.lit(0)
    dropped = F.when(F.length(window) > 0, places).otherwise(F.array().cast("array<int>"))
    emitted = F.when(
        F.col("longer"), F.transform(dropped, lambda p: key("insert", none, without(p), 1))
    ).otherwise(
        F.concat(
            F.transform(dropped, lambda p: key("replace", p, without(p), 2)),
            F.array(key("insert", none, window, 0)),
        )
    )
    return windows.select("at", *_LINE, F.explode(emitted).alias("v")).select("at", *_LINE, "v.*").distinct()


def near_lines(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """h1, h2 of the distinct lines that have an earlier line within one edit.

    `lines` has h1, h2 and the text of each occurrence, `distinct` one row per line with `at` and `keys`.
    Equal variants meet in groups of different lines, which the alphabet bounds; each line takes the earliest of its
    group, and the pair is kept if the edit distance of the texts confirms it.
    """
    halves = distinct.select(*_LINE, F.explode("keys").alias("key"))
    known = _shared(halves, "key").select(*_LINE).distinct()
    first = distinct.select("at", *_LINE).join(known, _LINE)
    # only the first place of a line is read, so a line that is everywhere is one row here
    texts = stage(lines.select("at", *_LINE, "line").join(first, ["at", *_LINE]), "near-lines")
    variants = _variants(_shared(_windows(texts), "around"))
    group = Window.partitionBy("g1", "g2")
    who = F.struct("at", *_LINE)
    partner = (
        F.when(F.col("role") == 2, F.min(who).over(group))
        .when(F.col("role") == 1, F.min(F.when(F.col("role") == 0, who)).over(group))
        .otherwise(F.min(F.when(F.col("role") == 1, who)).over(group))
    )
    pairs = (
        variants.withColumn("partner", partner)
        .where(F.col("partner.at") < F.col("at"))
        .select(*_LINE, F.col("partner.h1").alias("p1"), F.col("partner.h2").alias("p2"))
        .distinct()
    )
    own, other = texts.select(*_LINE, "line"), texts.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("line").alias("earlier"))
    return (
        pairs.join(own, _LINE)
        .join(other, ["p1", "p2"])
        .where(F.levenshtein("line", "earlier", 1) == 1)
        .select(*_LINE)
        .distinct()
    )


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_text: bool = False) -> DataFrame:
    """One row per line that goes: id, no, near (false: an exact copy of an earlier line), by text also t1, t2.

    A line goes if an earlier line is equal to it, or is within one edit and both are compared by edits (NEAR_CHARS);
    the earliest of them stays. Earlier is by identifier, then line number, null identifiers last. Blank lines stay.
    Rows that repeat an identifier hold the same places, so equal lines of theirs go or stay together.
    """
    more = _TEXT if by_text else []
    lines = line_rows(docs, id_col, text_col)
    near = F.length("line") >= NEAR_CHARS
    keyed = lines.withColumn("keys", F.when(near, _halves(F.col("line"))))
    distinct = keyed.groupBy(*_LINE).agg(
        F.min("at").alias("at"), F.count(F.lit(1)).alias("n"), *[F.min(F.get("keys", F.lit(i))).alias(f"k{i}") for i in range(4)]
    )
    distinct = stage(distinct, "lines").withColumn("keys", F.when(F.col("k0").isNotNull(), F.array("k0", "k1", "k2", "k3")))
    close = near_lines(lines.where(near), distinct.where(F.col("keys").isNotNull()))
    close = stage(close, "near").withColumn("near", F.lit(True))
    marked = distinct.join(close, _LINE, "left").where((F.col("n") > 1) | F.col("near"))
    marked = marked.select(*_LINE, F.col("at").alias("first_at"), F.coalesce("near", F.lit(False)).alias("near"))
    return (
        lines.select("id", "no", "at", *_LINE, *more)
        .join(marked, _LINE)
        .where(F.col("near") | (F.col("at") != F.col("first_at")))
        .select("id", "no", "near", *more)
    )


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per identifier: its id column, n_lines, n_exact and n_near (lines that go), dropped (their numbers, from 0).

    Null and empty texts have one blank line. Rows that repeat an identifier count as one document with the lines of
    all; null identifiers share one row. An empty table gives an empty result.
    """
    gone = (
        line_decisions(docs, id_col, text_col)
        .groupBy("id")
        .agg(
            F.count_if(~F.col("near")).alias("n_exact"),
            F.count_if("near").alias("n_near"),
            F.array_join(F.array_sort(F.collect_set("no")), ",").alias("dropped"),
        )
    )
    sizes = docs.select(F.col(id_col).cast("long").alias("id"), F.size(F.split(whole(text_col), "\n", -1)).alias("n"))
    sizes = sizes.groupBy(F.col("id").alias("doc")).agg(F.sum("n").cast("long").alias("n_lines"))
    return sizes.join(gone, F.col("doc").eqNullSafe(F.col("id")), "left").select(
        F.col("doc").alias(id_col),
        "n_lines",
        F.coalesce("n_exact", F.lit(0)).alias("n_exact"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce("dropped", F.lit("")).alias("dropped"),
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their text without the lines that go; all rows and columns stay, a null text stays null.

    A line goes by its row's identifier and text: other texts under the same or no identifier keep theirs.
    """
    name, numbers, t1, t2 = apart(docs.columns, "gone_id", "gone_lines", *_TEXT)
    gone = line_decisions(docs, id_col, text_col, by_text=True).groupBy("id", *_TEXT).agg(F.collect_set("no").alias("gone"))
    gone = gone.toDF(name, t1, t2, numbers)
    k1, k2 = _text_keys(whole(docs[text_col]))
    same = docs[id_col].cast("long").eqNullSafe(gone[name]) & (k1 == gone[t1]) & (k2 == gone[t2])
    joined = docs.join(gone, same, "left")
    kept = F.filter(F.split(docs[text_col], "\n", -1), lambda line, i: ~F.array_contains(F.col(numbers), i))
    return joined.withColumn(
        text_col, F.when(F.col(numbers).isNull(), docs[text_col]).otherwise(F.array_join(kept, "\n"))
    ).drop(name, numbers, t1, t2)
