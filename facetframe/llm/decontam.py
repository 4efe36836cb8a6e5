"""Benchmark decontamination through a positional inverted index of the documents.

The index stores a posting (term, document, position) for every document word that some benchmark
item has; terms are 64-bit hashes and the last step compares words. Of each window of ``n``
consecutive item words the two rarest terms by number of postings are looked up: the lists of the
rarest give places where the window may stand, and the list of the second, adjusted by its offset,
must confirm them within ``slack`` positions. These are the proximity matches. Around each of them
the words of document and item are compared, which gives the exact matches. An item with fewer words
than a window is one window.

Documents to compare are found by a filter with at most ``FILTER_SLOTS`` hash values, a fixed bound
for its broadcast, followed by an exact join. The benchmark's terms are broadcast only where their
counted number is below ``MOST_BROADCAST``.

Defined cases: null, empty and word-free texts have no words, hits or windows; a null id is a
document like any other; rows are told apart by id and text, and equal rows get equal results; items are told
apart by id and text too, of which those with one id count as one item and a null id is an empty one;
equal
windows of several items count for each item; equally rare terms go by position; empty tables give
no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from facetframe.llm.common import ascii_lower
from facetframe.sources.scratch import stored

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FILTER_SLOTS = 1 << 20
MOST_BROADCAST = 32 << 20
NO_ID = -(1 << 63)


def split_words(text: Column) -> Column:
    """The words of a text; an empty string may stand before the first and after the last."""
    return F.split(ascii_lower(text), BETWEEN_WORDS, -1)


def n_words(text: Column) -> Column:
    parts = split_words(text)
    outer = (parts[0] == "").cast("int") + (F.element_at(parts, -1) == "").cast("int")
    return F.coalesce(F.greatest(F.size(parts) - outer, F.lit(0)), F.lit(0)).cast("long")


def _bytes(rows: DataFrame, words: str | None = None) -> int:
    """About what the rows take: 64 bytes each and the bytes of an array of words."""
    size = F.lit(64)
    if words is not None:
        size = size + F.octet_length(F.array_join(words, "")) + 24 * F.size(words)
    return rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def _small(rows: DataFrame, size: int) -> DataFrame:
    return F.broadcast(rows) if size <= MOST_BROADCAST else rows


def _known(items: DataFrame) -> DataFrame:
    """Items by an ``item_id`` that tells rows with one id and different texts apart, each once."""
    name = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    own = F.struct(name.alias("name"), F.sha2("text", 256).alias("text"))
    return items.filter(F.col("text").isNotNull()).select(own.alias("item_id"), "text").distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.crc32(F.col("text").cast("binary")).alias("tag"),
        "doc_id",
        "text",
    )


def _item_words(items: DataFrame) -> DataFrame:
    return (
        items.filter(F.col("text").isNotNull())
        .select("item_id", F.array_remove(split_words(F.col("text")), "").alias("words"))
        .filter(F.size("words") > 0)
    )


def positional_index(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Stored postings ``term``, ``doc``, ``tag``, ``pos`` of the words that items have."""
    terms = (
        _item_words(items)
        .select(F.explode("words").alias("word"))
        .select(F.xxhash64("word").alias("term"))
        .distinct()
    )
    terms = stored(terms, "benchmark_terms")
    tokens = _keyed(docs.filter(F.col("text").isNotNull())).select(
        "doc", "tag", F.posexplode(split_words(F.col("text"))).alias("pos", "word")
    )
    postings = tokens.select(F.xxhash64("word").alias("term"), "doc", "tag", "pos")
    return stored(postings.join(_small(terms, _bytes(terms)), "term", "left_semi"), "postings")


def rarest_pairs(items: DataFrame, postings: DataFrame, n: int) -> DataFrame:
    """For each item the places of the two rarest terms of its windows, with the words around.

    Columns: ``item_id``, ``first_term``, ``second_term``, ``ahead`` (positions from the first to
    the second), ``around`` (the item's words up to n - 1 before and after the first), ``before``
    (how many of them stand before it), ``least`` (words that an exact match must have).
    """
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("times"))
    placed = _item_words(items).select(
        "item_id", F.size("words").alias("size"), F.posexplode("words").alias("pos", "word")
    )
    placed = placed.withColumn("term", F.xxhash64("word")).join(counts, "term", "left")
    # A window covers at most n rows of an item, itself a row of the benchmark.
    ahead = Window.partitionBy("item_id").orderBy("pos").rowsBetween(0, n - 1)
    place = F.struct(F.coalesce("times", F.lit(0)).alias("times"), "pos", "term")
    windows = (
        placed.withColumn("window", F.array_sort(F.collect_list(place).over(ahead)))
        .filter((F.col("pos") + n <= F.col("size")) | (F.col("pos") == 0))
        .select(
            "item_id",
            F.col("window")[0].alias("first"),
            F.coalesce(F.get("window", F.lit(1)), F.col("window")[0]).alias("second"),
        )
        .select(
            "item_id",
            F.col("first.pos").alias("at"),
            F.col("first.term").alias("first_term"),
            F.col("second.term").alias("second_term"),
            (F.col("second.pos") - F.col("first.pos")).alias("ahead"),
        )
        .distinct()
    )
    before = F.least(F.col("at"), F.lit(n - 1))
    return (
        windows.join(_item_words(items), "item_id")
        .withColumn("before", before)
        .select(
            "item_id",
            "first_term",
            "second_term",
            "ahead",
            "before",
            F.slice("words", F.col("at") - F.col("before") + 1, F.col("before") + n).alias("around"),
            F.least(F.lit(n), F.size("words")).alias("least"),
        )
    )


def proximity_matches(postings: DataFrame, pairs: DataFrame, slack: int) -> DataFrame:
    """Places where the two rarest terms of a window stand within ``slack`` of their distance."""
    pairs = stored(pairs, "rarest_pairs")
    size = _bytes(pairs, "around")
    found = postings.join(
        _small(pairs, size), F.col("term") == F.col("first_term")
    ).drop("term", "first_term")
    seconds = postings.join(
        _small(pairs.select(F.col("second_term").alias("term")).distinct(), size),
        "term",
        "left_semi",
    ).select("term", "doc", "tag", F.col("pos").alias("second_pos"))
    # Both lists are cut by document and term, so a term that most documents have is spread.
    near = F.abs(F.col("second_pos") - F.col("pos") - F.col("ahead")) <= slack
    return found.withColumnRenamed("second_term", "term").join(
        seconds.withColumnsRenamed({"doc": "doc2", "tag": "tag2", "term": "term2"}),
        (F.col("doc") == F.col("doc2"))
        & (F.col("tag") == F.col("tag2"))
        & (F.col("term") == F.col("term2"))
        & near,
        "left_semi",
    )


def _matching(words: Column, around: Column, steps: Column, pos: Column, at: Column, way: int) -> Column:
    """How many words in a row agree, going from a place before or behind."""
    return F.aggregate(
        steps,
        F.lit(0),
        lambda n, k: F.when(
            (n == k - 1) & (F.get(words, pos + way * k) == F.get(around, at + way * k)), k
        ).otherwise(n),
    )


def exact_matches(docs: DataFrame, near: DataFrame, n: int) -> DataFrame:
    """``doc``, ``tag``, ``item_id``, ``start``, ``end`` of word runs that contain whole windows."""
    places = near.groupBy("doc", "tag").agg(
        F.collect_set(F.struct("item_id", "pos", "before", "around", "least")).alias("places")
    )
    places = stored(places, "near_places")
    slot = F.pmod(F.xxhash64("doc", "tag"), F.lit(FILTER_SLOTS))
    slots = places.select(slot.alias("slot")).distinct()
    texts = (
        _keyed(docs.filter(F.col("text").isNotNull()))
        .withColumn("slot", slot)
        .join(F.broadcast(slots), "slot", "left_semi")
        .select("doc", "tag", "text")
        .join(places, ["doc", "tag"])
        .select("doc", "tag", split_words(F.col("text")).alias("words"), "places")
    )
    words = F.col("words")
    steps = F.array(*[F.lit(k) for k in range(1, n)])

    def compared(place: Column) -> Column:
        around, at, pos = place["around"], place["before"], place["pos"]
        back = _matching(words, around, F.slice(steps, F.lit(1), at), pos, at, -1)
        rest = F.size(around) - at - 1
        forth = _matching(words, around, F.slice(steps, F.lit(1), rest), pos, at, 1)
        same = F.get(words, pos) == F.get(around, at)
        return F.struct(
            place["item_id"].alias("item_id"),
            (pos - back).alias("start"),
            (pos + forth).alias("end"),
            (same & (back + forth + 1 >= place["least"])).alias("whole"),
        )

    runs = F.filter(F.transform("places", compared), lambda r: r["whole"])
    return (
        texts.select("doc", "tag", F.explode(runs).alias("run"))
        .select("doc", "tag", "run.item_id", "run.start", "run.end")
        .distinct()
    )


def covered_words(runs: Column) -> Column:
    """The number of positions in a sorted array of (start, end), ends included."""
    none = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("upto"))
    return F.aggregate(
        runs,
        none,
        lambda s, r: F.struct(
            (
                s["n"] + F.greatest(r["end"] - F.greatest(r["start"] - 1, s["upto"]), F.lit(0))
            ).alias("n"),
            F.greatest(s["upto"], r["end"]).alias("upto"),
        ),
        lambda s: s["n"],
    )


def _near(docs: DataFrame, items: DataFrame, n: int, slack: int) -> DataFrame:
    postings = positional_index(docs, items)
    return stored(
        proximity_matches(postings, rarest_pairs(items, postings, n), slack), "proximity_matches"
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, n: int = 10, slack: int = 3
) -> DataFrame:
    """The documents in which no window of an item occurs, with all their columns."""
    items = _known(items)
    slim = docs.select("doc_id", "text")
    found = exact_matches(slim, _near(slim, items, n, slack), n)
    found = found.select(F.col("doc").alias("__doc"), F.col("tag").alias("__tag")).distinct()
    own = F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID))
    tag = F.crc32(docs["text"].cast("binary"))
    return docs.join(found, (own == F.col("__doc")) & (tag == F.col("__tag")), "left_anti")


def contamination(docs: DataFrame, items: DataFrame, n: int = 10, slack: int = 3) -> DataFrame:
    """One row for each document: its words, those hit by item windows, and the items.

    ``items`` are ids in the order of their strings, ``near_items`` counts the items with proximity
    matches, exact or not.
    """
    docs = docs.select("doc_id", "text")
    items = _known(items)
    near = _near(docs, items, n, slack)
    found = exact_matches(docs, near, n)
    per_doc = found.groupBy("doc", "tag").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("runs"),
        F.array_sort(F.collect_set("item_id.name")).alias("items"),
    )
    hits = per_doc.select(
        "doc", "tag", covered_words(F.col("runs")).cast("long").alias("n_hit"), "items"
    )
    close = near.groupBy("doc", "tag").agg(F.count_distinct("item_id.name").alias("near_items"))
    none = F.array().cast("array<string>")
    return (
        _keyed(docs)
        .select("doc", "tag", "doc_id", n_words(F.col("text")).alias("n_words"))
        .join(hits, ["doc", "tag"], "left")
        .join(close, ["doc", "tag"], "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near_items", F.lit(0)).alias("near_items"),
        )
    )
