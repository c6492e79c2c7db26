"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces of sentences, as DataFrame expressions.

Leaves are pieces of at most 64 characters that end where a sentence ends; lines are paragraphs; a section ends with a paragraph
whose digest says so (one in eight), so a line put in or taken out moves no other section's bounds.  A node's digest covers its
children's.  Roots are equal for equal texts; where two roots differ, differing sections and then paragraphs show where the texts do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.llm.rules import let

PIECE = r"[^.!?]{1,64}[.!?]*|[.!?]+"
#: Last hexadecimal digits of a paragraph that ends a section.
SECTION_END = ("0", "8")
#: Rows of one id from which on its rows are dealt by a hash of the text as well; and the rows of such a slice.
HOT_ID, SLICE_ROWS = 200_000, 100_000
LAST_ID = -(2**63)


def _digest(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.xxhash64(value))), 16, "0")


def fingerprint(text: Column) -> Column:
    """Root, sections, paragraphs and leaves of a text (null: empty), each level's digests joined by spaces, levels by ``|``."""
    paragraphs = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: F.transform(
        F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), _digest))

    def tree(leaves):
        nodes = F.transform(leaves, lambda x: _digest(F.array_join(x, " ")))
        return let(nodes, lambda n: let(
            let(_section_ends(n), lambda e: F.transform(e, lambda end, k: _digest(F.array_join(_between(n, e, end, k), " ")))),
            lambda s: F.concat_ws("|", F.sha2(F.array_join(s, " "), 256), F.array_join(s, " "), F.array_join(n, " "), F.array_join(F.flatten(leaves), " "))))

    return let(paragraphs, tree)


def _section_ends(nodes: Column) -> Column:
    """Numbers (from 1) of the paragraphs that end a section; the last one does."""
    return F.filter(F.sequence(F.lit(1), F.size(nodes)), lambda i: (i == F.size(nodes)) | F.substring(F.get(nodes, i - 1), -1, 1).isin(*SECTION_END))


def _between(nodes: Column, ends: Column, end: Column, number: Column) -> Column:
    """Paragraphs of the section that ends with paragraph ``end``, the ``number``-th (from 0)."""
    start = F.when(number == 0, F.lit(1)).otherwise(F.get(ends, number - 1) + 1)
    return F.slice(nodes, start, end - start + 1)


def level(print_: Column, number: int) -> Column:
    """Digests of a level: 1 sections, 2 paragraphs, 3 leaves."""
    return F.filter(F.split(F.get(F.split(print_, r"\|"), F.lit(number)), " "), lambda x: x != "")


def likeness(a: Column, b: Column) -> Column:
    """Shared part of the distinct leaves of two fingerprints; 1 for equal roots."""
    def share(x, y):
        both = F.size(F.array_intersect(x, y))
        return both / F.greatest(F.size(F.array_distinct(x)) + F.size(F.array_distinct(y)) - both, F.lit(1))

    leaves = let(level(a, 3), lambda x: let(level(b, 3), lambda y: share(x, y)))
    return F.when(F.substring(a, 1, 64) == F.substring(b, 1, 64), F.lit(1.0)).otherwise(leaves)


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Numbers (from 1) of the paragraphs of ``b`` that ``a`` does not have; those of sections that both have are not compared.

    Called the other way round, it lists what ``b`` has lost.  Paragraphs that only moved are in both.
    """
    def find(sa, pa, sb, pb):
        def inside(end, number, ends):
            start = F.when(number == 0, F.lit(1)).otherwise(F.get(ends, number - 1) + 1)
            same = F.array_contains(sa, F.get(sb, number))
            return F.filter(F.sequence(start, end), lambda i: ~same & ~F.array_contains(pa, F.get(pb, i - 1)))

        return let(_section_ends(pb), lambda ends: F.flatten(F.transform(ends, lambda end, number: inside(end, number, ends))))

    return let(level(a, 1), lambda sa: let(level(a, 2), lambda pa: let(level(b, 1), lambda sb: let(level(b, 2), lambda pb: find(sa, pa, sb, pb)))))


def parts_of(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text) with ``part``, a number that falls in the order of the rows, and ``tie``.

    Parts are ranges of ids between cuts at their quantiles.  An id with more than ``HOT_ID`` rows is cut off from its neighbours, and
    its own rows are cut by ranges of the text's hash.  So no part grows with the table, unless one text repeats under one id.
    """
    spark = rows.sparkSession
    slices = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = [k / slices for k in range(1, slices)]
    found = rows.select(F.col("id").cast("double").alias("x")).approxQuantile("x", wanted, 0.2 / slices)
    many = rows.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ID).collect()  # at most one id in HOT_ID rows
    if not many:
        cuts = F.split(F.lit(",".join(repr(c) for c in sorted(set(found)))), ",").cast("array<double>") if found else F.array().cast("array<double>")
        part = F.size(F.filter(cuts, lambda c: c <= F.col("id").cast("double"))).cast("long")
        return rows.withColumn("part", part).withColumn("tie", F.lit(0).cast("long"))
    # (lowest id of a range, its first number, its parts): ranges between the cuts, and one for each hot id
    ends = sorted({LAST_ID, *[min(int(c), 2**63 - 1) for c in found], *[r["id"] for r in many], *[r["id"] + 1 for r in many if r["id"] < 2**63 - 1]})
    wide = {r["id"]: -(-r["n"] // SLICE_ROWS) for r in many}
    ranges, number = [], 0
    for low in ends:
        ranges.append((low, number, wide.get(low, 1)))
        number += wide.get(low, 1)
    lows = F.lit(",".join(str(low) for low, _, _ in ranges))
    at = F.size(F.filter(F.split(lows, ",").cast("array<bigint>"), lambda c: c <= F.col("id"))).cast("long")
    table = F.broadcast(spark.createDataFrame([(i, first, parts) for i, (_, first, parts) in enumerate(ranges, 1)], "at long, first long, parts long"))
    placed = rows.withColumn("at", at).join(table, "at")
    tie = F.when(F.col("parts") > 1, F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    placed = placed.withColumn("tie", tie)
    # ids fall in the order of the rows and ties rise, so a rising tie has a falling number
    inner = F.col("parts") - 1 - F.least(F.floor((F.col("tie") / F.lit(2.0**64) + 0.5) * F.col("parts")), F.col("parts") - 1)
    return placed.withColumn("part", (F.col("first") + F.when(F.col("parts") > 1, inner).otherwise(F.lit(0))).cast("long")).drop("at", "first", "parts")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", added: dict[str, Column] | None = None) -> DataFrame:
    """(id, text, next_text, and for each of ``added``, expressions of id and text, itself and next_<name>) of all rows.

    The next row is that of the next lower id; after the last comes the first.  Null ids come last; equal ids are ordered by their
    texts.  Texts are dealt once, into sorted parts; the first row of each part is dealt to the part before it as well, where
    it only follows the last row.
    """
    added = added or {}
    rows = docs.select(F.col(id_col).alias("given"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut = parts_of(rows)
    heads = cut.groupBy("part").agg(F.max("id").alias("head_id"), F.min_by("tie", F.struct(-F.col("id").cast("decimal(20,0)"), "tie")).alias("head_tie")).collect()
    heads.sort(key=lambda r: r["part"], reverse=True)
    before = [(r["part"], heads[i - 1]["part"], r["head_id"], r["head_tie"]) for i, r in enumerate(heads)]
    table = F.broadcast(docs.sparkSession.createDataFrame(before, "part long, before long, head_id long, head_tie long"))  # a row a part
    first = (F.col("id") == F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    copies = F.when(first, F.array(F.struct(F.col("part").alias("at"), F.lit(False).alias("guest")), F.struct(F.col("before").alias("at"), F.lit(True).alias("guest"))))
    copies = copies.otherwise(F.array(F.struct(F.col("part").alias("at"), F.lit(False).alias("guest"))))
    dealt = cut.join(table, "part").select("given", "id", "tie", "text", F.explode(copies).alias("c")).select(
        "given", "id", "tie", "text", F.col("c.at").alias("at"), F.col("c.guest").alias("guest"))
    dealt = dealt.repartition("at").withColumns(added)
    order = Window.partitionBy("at").orderBy("guest", F.col("id").desc(), "tie", "text")
    names = ["text", *added]
    led = dealt.withColumns({f"next_{n}": F.lead(n).over(order) for n in names})
    return led.where(~F.col("guest")).select(F.col("given").alias("id"), *names, *[f"next_{n}" for n in names])


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third (rounded down, in code points) replaced by as many of the next row's first
    ones, or all if it has fewer.  Null texts are empty.  One row is its own next; an empty table gives no rows.  Repeated rows
    follow each other.  Only id and text of ``docs`` are used, whatever other columns are called.
    """
    rows = with_next(docs, id_col, text_col, {"fingerprint": fingerprint(F.col("text"))})
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = rows.select(F.col("id").alias("doc_id"), n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
    rows = rows.select("*", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_fingerprint"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
