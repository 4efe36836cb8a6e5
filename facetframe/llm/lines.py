"""Removal of repeated and nearly repeated lines by a segment-partition edit join.

Equal lines of at least ``exact_chars`` characters (``min_chars`` where it is not given) are grouped:
the first by document and line stays. Two lines of at least ``min_chars`` characters are linked where
their edit distance is at most ``edits``; a line linked with another that comes first elsewhere goes,
with all its copies. Lines below both bounds always stay.

A line is split into ``edits`` + 1 segments; a linked line must hold one of them unchanged at a
place that the lengths and the segment's number allow, so the segments are an index and the
substrings at those places its probes. Pairs that meet must also agree in how often fifteen letters
occur, which is packed into the line's id and costs nothing to carry; this keeps groups of lines
with a common segment from meeting pairwise. (Lines with equal letter counts and CRC-32 are not told
apart here, which two different lines share once in four billion pairs.) The rest is verified by a bit-parallel edit distance
on a band of 2 x ``edits`` + 1 bits. All of it is SQL functions.

Defined cases: a null text has no lines and stays null; an empty text is one empty line; rows with
the same id count as one document; a text whose lines all go is empty; an empty table gives an empty
result; extra columns stay in ``without_repeated_lines``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetframe.sources.scratch import stored

EDITS = 2
MIN_CHARS = 40
LETTERS = "etnaoirshldcumg"
FILTER_SLOTS = 1 << 20


def _let(value: Column, use) -> Column:
    """Evaluate a value once and use it several times."""
    return F.transform(F.array(value), use)[0]


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of two texts is at most ``edits`` (their lengths differ by no more).

    Bit k of the words stands for row j - edits + k of column j; the band moves down with each
    column. The distance is followed along the lowest diagonal until it leaves the table, then
    along the last row.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1

    def num(n: int) -> Column:
        return F.lit(n)

    def inverted(x: Column) -> Column:
        return x.bitwiseXOR(num(full))

    def bit(x: Column, k: Column | int) -> Column:
        return F.expr("1").bitwiseAND(
            F.shiftright(x, k) if isinstance(k, int) else F.call_function("shiftright", x, k)
        )

    def step(pattern: Column, text: Column, state: Column, j: Column) -> Column:
        m = F.size(pattern)
        one = F.get(text, j - 1)
        same = reduce(
            lambda x, y: x.bitwiseOR(y),
            [
                F.when(F.get(pattern, j - edits + k - 1) == one, num(1 << k)).otherwise(num(0))
                for k in range(width)
            ],
        )

        def moved(eq: Column) -> Column:
            vp, vn = state["vp"], state["vn"]
            carried = (eq.bitwiseAND(vp) + vp).bitwiseAND(num(full)).bitwiseXOR(vp)
            return F.struct(
                carried.bitwiseOR(eq).bitwiseOR(vn).alias("d0"), vp.alias("vp"), vn.alias("vn")
            )

        def across(s: Column) -> Column:
            return F.struct(
                s["d0"].alias("d0"),
                s["vn"].bitwiseOR(inverted(s["d0"].bitwiseOR(s["vp"]))).alias("hp"),
                s["d0"].bitwiseAND(s["vp"]).alias("hn"),
            )

        def after(s: Column) -> Column:
            down = F.shiftright(s["d0"], 1)
            row = m - j + edits
            change = F.when(j <= m - edits, 1 - bit(s["d0"], width - 1)).otherwise(
                bit(s["hp"], row) - bit(s["hn"], row)
            )
            return F.struct(
                s["hn"].bitwiseOR(inverted(down.bitwiseOR(s["hp"]))).alias("vp"),
                down.bitwiseAND(s["hp"]).alias("vn"),
                (state["distance"] + change).alias("distance"),
            )

        return _let(_let(_let(same, moved), across), after)

    def run(both: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(both["b"])),
            F.struct(
                num(full & ~((1 << edits) - 1)).alias("vp"),
                num(0).alias("vn"),
                F.least(F.size(both["a"]), num(edits)).alias("distance"),
            ),
            lambda s, j: step(both["a"], both["b"], s, j),
            lambda s: s["distance"],
        )

    def chars(text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))

    longer = F.length(a) > F.length(b)
    rows = chars(F.when(longer, b).otherwise(a))
    columns = chars(F.when(longer, a).otherwise(b))
    return _let(F.struct(rows.alias("a"), columns.alias("b")), run) <= edits


def _segment(gap: int, edits: int, number: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a segment: the last ones are longer where it does not divide."""
    parts = edits + 1
    if number == 0:
        return F.lit(0), F.col(f"base{gap}")
    base, more = F.col(f"base{gap}"), F.col(f"more{gap}")
    start = base * number
    if number > 1:
        start = start + F.greatest(more - (parts - number), F.lit(0))
    return start, base + (more >= parts - number).cast("int")


def _keys(long: DataFrame, name: str, edits: int, gaps: range, offsets) -> DataFrame:
    """``id`` as ``name`` and ``key``, a row for every place a segment may stand: hashes of (line
    length, segment number, substring).

    What the places share is computed in columns before: with it in every place the generated code
    is longer than the 8,000 bytes the JVM compiles at most, and then it is interpreted.
    """
    shared, found = [], []
    for gap in gaps:
        length = F.col("chars") - gap
        shared.append(F.floor(length / (edits + 1)).cast("int").alias(f"base{gap}"))
        shared.append((length % (edits + 1)).cast("int").alias(f"more{gap}"))
        for number in range(edits + 1):
            start, size = _segment(gap, edits, number)
            for offset in offsets(gap, number):
                part = F.substring(F.col("line"), start + 1 + offset, size)
                found.append(F.xxhash64(length, F.lit(number), part))
    rows = long.select("id", "line", "chars", *shared)
    return rows.select(F.col("id").alias(name), F.explode(F.array(*found)).alias("key"))


def _probe_offsets(edits: int):
    """Shifts of a segment that edits before it and after it can explain."""

    def offsets(gap: int, number: int) -> range:
        after = edits - number
        return range(max(-number, gap - after), min(number, gap + after) + 1)

    return offsets


def _id(line: Column) -> Column:
    """Length and letter counts modulo 4 in the upper half, a CRC-32 in the lower.

    The letters are of one byte, so bytes are compared: characters would have to be counted each time.
    """
    size = F.octet_length(line)
    counts = [F.length(line)] + [
        size - F.octet_length(F.replace(line, F.lit(c), F.lit(""))) for c in LETTERS
    ]
    return reduce(
        lambda x, y: x.bitwiseOR(y),
        [F.shiftleft((n % 4).cast("long"), 32 + 2 * k) for k, n in enumerate(counts)],
        F.crc32(line.cast("binary")),
    )


def _may_be_linked(a: Column, b: Column, edits: int) -> Column:
    """What the ids of an indexed line and of a probing one tell; equal lengths in one order only.

    The probing line is longer by 0 to ``edits`` (at most 3) characters. An edit that replaces
    changes two letter counts, one that inserts changes one.
    """
    parts = []
    for k in range(1, len(LETTERS) + 1):
        one, two = (F.shiftrightunsigned(x, 32 + 2 * k).bitwiseAND(F.lit(3)) for x in (a, b))
        gap = F.abs(one - two)
        parts.append(F.least(gap, 4 - gap))
    longer = (F.shiftrightunsigned(b, 32) - F.shiftrightunsigned(a, 32)).bitwiseAND(F.lit(3))
    differ = reduce(lambda x, y: x + y, parts)
    return ((longer != 0) | (a < b)) & (differ + longer <= 2 * edits)


def _occurrences(docs: DataFrame, least_chars: int) -> DataFrame:
    """``doc``, ``number`` and ``line`` of every line that is long enough."""
    return (
        docs.filter(F.col("text").isNotNull())
        .select(
            F.col("doc_id").cast("long").alias("doc"),
            F.posexplode(F.split("text", "\n", -1)).alias("number", "line"),
        )
        .filter(F.length("line") >= least_chars)
    )


def _order(doc: Column, number: Column) -> Column:
    """One number that orders lines by document and line; null ids come last."""
    whole = F.coalesce(doc, F.lit((1 << 63) - 1)).cast("decimal(38,0)")
    return (whole * F.lit(1 << 31).cast("decimal(11,0)") + number).cast("decimal(38,0)")


def _least_chars(min_chars: int, exact_chars: int | None) -> int:
    return min_chars if exact_chars is None else min(exact_chars, min_chars)


def line_links(
    docs: DataFrame, edits: int, min_chars: int, exact_chars: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The distinct lines (``line``, ``first``, ``n``, ``chars``, ``id``) and the links between them.
    """
    if not 0 < edits <= 3 or min_chars <= 2 * edits:
        raise ValueError("1 to 3 edits, and lines of more than twice as many characters")
    lines = (
        _occurrences(docs, _least_chars(min_chars, exact_chars))
        .withColumn("at", _order(F.col("doc"), F.col("number")))
        .groupBy("line")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .select(
            "line",
            "first",
            "n",
            F.length("line").alias("chars"),
            F.when(F.length("line") >= min_chars, _id(F.col("line"))).alias("id"),
        )
    )
    # The largest table of the operator: texts take a third less room than by the default codec.
    lines = stored(lines, "distinct_lines", compression="zstd")
    long = lines.filter(F.col("chars") >= min_chars)
    index = _keys(long, "a", edits, range(1), lambda *_: [0])
    probes = _keys(long, "b", edits, range(edits + 1), _probe_offsets(edits))
    similar = _may_be_linked(F.col("a"), F.col("b"), edits)
    met = index.join(probes, (index["key"] == probes["key"]) & similar)
    pairs = stored(
        met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "line_pairs",
    )
    # Texts of the lines in pairs: a filter of bounded size first, then exact joins.
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_SLOTS)).alias("slot")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    wanted = (
        long.withColumn("slot", slot)
        .join(F.broadcast(ids.select(slot).distinct()), "slot", "left_semi")
        .select("id", "line", "first", "chars")
    )
    one = wanted.select(*[F.col(c).alias(f"{c}_a") for c in wanted.columns])
    two = wanted.select(*[F.col(c).alias(f"{c}_b") for c in wanted.columns])
    links = (
        pairs.join(one, F.col("a") == F.col("id_a"))
        .join(two, F.col("b") == F.col("id_b"))
        .filter(F.abs(F.col("chars_a") - F.col("chars_b")) <= edits)
        .filter(within_edits(F.col("line_a"), F.col("line_b"), edits))
        .select("line_a", "line_b", "first_a", "first_b")
    )
    return lines, stored(links, "line_links")


def line_report(
    docs: DataFrame,
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
    exact_chars: int | None = None,
) -> DataFrame:
    """Per document id with a repeated or linked line: ``doc``, ``dropped`` (sorted line numbers from
    0), ``n_links``.

    ``n_links`` counts, over the document's lines, the different lines that each is linked with.
    """
    lines, links = line_links(docs, edits, min_chars, exact_chars)
    ways = links.unionByName(
        links.select(
            F.col("line_b").alias("line_a"),
            F.col("line_a").alias("line_b"),
            F.col("first_b").alias("first_a"),
            F.col("first_a").alias("first_b"),
        )
    )
    # Different lines of rows with one id can share a place; the line itself then decides.
    earlier = F.struct("first_b", "line_b") < F.struct("first_a", "line_a")
    linked = ways.groupBy(F.xxhash64("line_a").alias("hash"), F.col("first_a").alias("first")).agg(
        F.count(F.lit(1)).alias("n_links"), F.max(earlier).alias("later")
    )
    crc = F.crc32(F.col("line").cast("binary")).alias("crc")
    # Lines that occur once and have no links need no look at their occurrences.
    known = (
        lines.select(F.xxhash64("line").alias("hash"), crc, "first", "n")
        .join(linked, ["hash", "first"], "left")
        .filter((F.col("n") > 1) | F.col("n_links").isNotNull())
        .drop("n")
    )
    # Equal lines are known by 96 bits of hashes, so that their text is not shuffled again.
    found = _occurrences(docs, _least_chars(min_chars, exact_chars)).select(
        "doc", "number", F.xxhash64("line").alias("hash"), crc
    )
    at = _order(F.col("doc"), F.col("number"))
    gone = F.coalesce("later", F.lit(False)) | F.coalesce(at != F.col("first"), F.lit(False))
    return (
        found.join(known, ["hash", "crc"])
        .groupBy("doc")
        .agg(
            F.array_sort(F.collect_set(F.when(gone, F.col("number")))).alias("dropped"),
            F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_links"),
        )
    )


def line_counts(
    docs: DataFrame,
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
    exact_chars: int | None = None,
) -> DataFrame:
    """One row per document: its lines, how many of them go and which, and its links."""
    report = line_report(docs, edits, min_chars, exact_chars)
    return docs.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
    ).join(report, F.col("doc_id").cast("long").eqNullSafe(F.col("doc")), "left").select(
        "doc_id",
        F.when(F.col("n_lines") > 0, F.col("n_lines")).otherwise(F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def without_repeated_lines(
    docs: DataFrame,
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
    exact_chars: int | None = None,
) -> DataFrame:
    """The documents with their repeated lines taken out of ``text``."""
    dropped = line_report(docs, edits, min_chars, exact_chars).filter(F.size("dropped") > 0)
    dropped = dropped.select(F.col("doc").alias("__doc"), F.col("dropped").alias("__dropped"))
    parts = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__dropped"))
    shorter = _let(parts, lambda all_: F.array_join(F.transform(kept, lambda i: all_[i]), "\n"))
    text = F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(shorter)
    return docs.join(
        dropped, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")), "left"
    ).select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
