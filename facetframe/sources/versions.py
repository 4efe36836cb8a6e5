"""Tables in versions: batches in folders of their own, published by one small file written last.

A version is a file that names the batches it consists of. A writer puts its batch into a new folder
and then writes the next version; readers take the newest version they find, so they see all of a batch
or nothing, and what an older version names stays until ``vacuum``. A writer that stops in between leaves
a folder that no version names. Batches carry an id: one that was applied is not applied again.

A table with a ``key`` also takes updates and deletions. Such a batch brings the keys it replaces as
delete marks; they hide rows and postings of older batches when these are read, until ``compact_batches``
folds them in. So a batch costs as much as its own rows, whatever the table holds.

Batches may bring new columns and wider types where ``evolve`` is asked for: the table's schema grows, and
older files are read through it.

The layout (partition columns, sort, promoted and filtered paths, posted paths, summaries) belongs to
the table, and every batch follows it. Below the root: ``versions`` (the small files), ``rows``, ``terms``,
``marks`` and ``sums-<name>``, each with one folder per batch, which readers prune like any partition.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    NumericType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from facetframe.functions import paths as P
from facetframe.operators.postings import (
    COLUMNS,
    check_key,
    check_new_keys,
    postings,
    write_postings,
)
from facetframe.sources.files import child_names, read_text, write_text
from facetframe.sources.scratch import remove_path
from facetframe.sources.tables import Layout, in_columns_of, laid_out, save_laid_out, write_rows

BATCH = "__batch"
PATH = "__path"


class ChangedMeanwhile(RuntimeError):
    """Another writer published the version this one was about to publish. Nothing was changed."""


@dataclass(frozen=True)
class Summary:
    """Counts, least, largest and sums of ``values`` by ``by`` (paths), kept with every batch."""

    name: str
    by: tuple[str, ...]
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Batch:
    """A folder of rows, marks or both. Names order as the batches do."""

    name: str
    id: str | None = None
    rows: bool = True
    marks: bool = False


@dataclass(frozen=True)
class Version:
    """What one version of a table consists of."""

    number: int
    schema: str
    layout: Layout = Layout()
    key: str | None = None
    posted: tuple[str, ...] = ()
    terms_schema: str | None = None
    summaries: tuple[Summary, ...] = ()
    batches: tuple[Batch, ...] = ()
    applied: tuple[str, ...] = field(default=(), repr=False)

    def to_text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_text(text: str) -> Version:
        parts = json.loads(text)
        parts["layout"] = Layout.of(parts["layout"])
        parts["summaries"] = tuple(
            Summary(s["name"], tuple(s["by"]), tuple(s["values"])) for s in parts["summaries"]
        )
        parts["batches"] = tuple(Batch(**b) for b in parts["batches"])
        return Version(**{k: tuple(v) if isinstance(v, list) else v for k, v in parts.items()})

    def names(self, kind: str) -> list[str]:
        return [b.name for b in self.batches if getattr(b, kind)]


def _version_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/versions/{number:010d}.json"


def version_numbers(spark: SparkSession, root: str) -> list[int]:
    names = child_names(spark, f"{root.rstrip('/')}/versions")
    return [int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")]


def table_version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version of the table, the newest by default."""
    numbers = version_numbers(spark, root)
    if not numbers or (number is not None and number not in numbers):
        raise ValueError(f"no version {'' if number is None else number} at {root}; there are {numbers}")
    return Version.from_text(read_text(spark, _version_path(root, number or numbers[-1])))


def _publish(spark: SparkSession, root: str, version: Version) -> Version:
    path = _version_path(root, version.number)
    if not write_text(spark, path, version.to_text(), overwrite=False):
        raise ChangedMeanwhile(f"version {version.number} of {root} was written by another writer")
    return version


def _folder(root: str, kind: str, batch: str) -> str:
    return f"{root.rstrip('/')}/{kind}/{BATCH}={batch}"


def _batch_name(number: int) -> str:
    return f"b{number:010d}-{uuid4().hex[:8]}"


def create_versioned(
    df: DataFrame,
    root: str,
    *,
    layout: Layout = Layout(),
    key: str | None = None,
    posted: Sequence[str] = (),
    summaries: Sequence[Summary] = (),
    batch: str | None = None,
) -> Version:
    """Start a table with these rows as its first batch.

    ``posted`` paths get postings with every batch and need a ``key``; ``summaries`` are kept per batch
    and merged when read.
    """
    spark = df.sparkSession
    if version_numbers(spark, root):
        raise ValueError(f"there is a table at {root}")
    if posted and key is None:
        raise ValueError("postings need a key")
    plain = P.without_promoted(df)
    schema = laid_out(plain, layout).schema
    terms = postings(plain, key, posted, key_is_checked=True).schema.json() if posted else None
    start = Version(0, schema.json(), layout, key, tuple(posted), terms, tuple(summaries))
    return _add(df, root, start, batch, checked=False)


def _add(
    df: DataFrame,
    root: str,
    before: Version,
    batch: str | None,
    *,
    checked: bool,
    marks: DataFrame | None = None,
) -> Version:
    """Write one batch beside the table and publish it. The steps may be repeated from the start."""
    spark = df.sparkSession
    if before.key is not None and not checked:
        check_key(df, before.key)
    made = Batch(_batch_name(before.number + 1), batch, marks=marks is not None)
    _write_batch(df, root, before, made.name)
    if marks is not None:
        marks.write.parquet(_folder(root, "marks", made.name))
    applied = before.applied if batch is None else (*before.applied, batch)
    after = replace(
        before, number=before.number + 1, batches=(*before.batches, made), applied=applied
    )
    return _publish(spark, root, after)


def _write_batch(df: DataFrame, root: str, version: Version, name: str) -> None:
    plain = P.without_promoted(df)
    write_rows(plain, _folder(root, "rows", name), version.layout, "errorifexists")
    if not (version.posted or version.summaries):
        return
    # From the written rows, so that a costly or unstable source is run once.
    rows = _stored_rows(df.sparkSession, root, version, [name])
    if version.posted:
        terms = postings(rows, version.key, version.posted, key_is_checked=True)
        write_postings(terms, _folder(root, "terms", name))
    for summary in version.summaries:
        partial = _partial(rows, summary)
        partial.write.parquet(_folder(root, f"sums-{summary.name}", name))


def _stored_rows(
    spark, root: str, version: Version, names: Sequence[str], *, files: bool = False
) -> DataFrame:
    """Rows of some batches with the column ``__batch``, and ``__path`` with ``files``.

    Pruned to the folders of the batches.
    """
    schema = StructType.fromJson(json.loads(version.schema)).add(BATCH, StringType())
    rows = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/rows")
    path = [F.col("_metadata.file_path").alias(PATH)] if files else []
    return rows.filter(F.col(BATCH).isin(list(names))).select(*map(P.quoted, schema.names), *path)


def _marks(spark, root: str, version: Version) -> DataFrame | None:
    """``__key`` and the newest batch ``__marked`` that replaces or deletes it."""
    names = version.names("marks")
    if not names:
        return None
    kind = StructType.fromJson(json.loads(version.schema))[version.key].dataType
    schema = StructType().add("key", kind).add(BATCH, StringType())
    marks = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/marks")
    marks = marks.filter(F.col(BATCH).isin(names))
    return marks.groupBy(F.col("key").alias("__key")).agg(F.max(BATCH).alias("__marked"))


def _without_marked(
    spark, root: str, version: Version, names: Sequence[str], read, key: str
) -> DataFrame:
    """What ``read`` gives for the batches, without what newer marks hide.

    Batches newer than every mark are read as they are.
    """
    newest = max(version.names("marks"), default="")
    old, new = [n for n in names if n < newest], [n for n in names if n >= newest]
    if not old:
        return read(new)
    marks = _marks(spark, root, version)
    rows = read(old)
    hidden = (F.col(P.quoted(key)) == F.col("__key")) & (F.col(BATCH) < F.col("__marked"))
    kept = rows.join(marks, hidden, "left_anti")
    return kept.unionByName(read(new)) if new else kept


def _visible(spark, root: str, version: Version, names: Sequence[str], **how) -> DataFrame:
    def read(chosen: Sequence[str]) -> DataFrame:
        return _stored_rows(spark, root, version, chosen, **how)

    return _without_marked(spark, root, version, names, read, version.key or "").drop(BATCH)


def read_versioned(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default; promoted columns stay available.

    The DataFrame keeps reading this version, whatever is published later, until ``vacuum``.
    """
    version = table_version(spark, root, number)
    return _visible(spark, root, version, version.names("rows"))


def versioned_postings(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The postings of a version, for lookups on the rows that ``read_versioned`` gives."""
    version = table_version(spark, root, number)
    if version.terms_schema is None:
        raise ValueError(f"the table at {root} has no posted paths")
    schema = StructType.fromJson(json.loads(version.terms_schema)).add(BATCH, StringType())

    def read(chosen: Sequence[str]) -> DataFrame:
        terms = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/terms")
        return terms.filter(F.col(BATCH).isin(list(chosen)))

    found = _without_marked(spark, root, version, version.names("rows"), read, "key")
    return found.select(*COLUMNS).withMetadata("path", schema["path"].metadata)


def append_batch(
    df: DataFrame,
    root: str,
    batch: str | None = None,
    *,
    new_keys: bool = False,
    evolve: bool = False,
) -> Version:
    """Append rows. With an id, a batch that was applied before changes nothing.

    With ``new_keys`` the caller vouches that no key is in the table; else the new keys are looked for
    in the table's key column. With ``evolve`` the rows may have columns that the table lacks, lack some
    of its columns, and have types that are wider or narrower.
    """
    spark = df.sparkSession
    before = table_version(spark, root)
    if batch is not None and batch in before.applied:
        return before
    df, before = _fitted(df, before, evolve)
    if before.key is not None and not new_keys:
        check_new_keys(df, read_versioned(spark, root), before.key)
    return _add(df, root, before, batch, checked=before.key is not None and not new_keys)


def upsert_batch(
    df: DataFrame, root: str, batch: str | None = None, *, evolve: bool = False
) -> Version:
    """Add rows and hide all older rows with their keys. The table itself is not read."""
    spark = df.sparkSession
    before = table_version(spark, root)
    if batch is not None and batch in before.applied:
        return before
    if before.key is None:
        raise ValueError(f"the table at {root} has no key")
    df, before = _fitted(df, before, evolve)
    marks = df.select(F.col(P.quoted(before.key)).alias("key"))
    return _add(df, root, before, batch, checked=False, marks=marks)


def delete_batch(keys: DataFrame, root: str, batch: str | None = None) -> Version:
    """Hide all rows whose key is in the first column of ``keys``. Null keys hide nothing."""
    spark = keys.sparkSession
    before = table_version(spark, root)
    if batch is not None and batch in before.applied:
        return before
    if before.key is None:
        raise ValueError(f"the table at {root} has no key")
    kind = StructType.fromJson(json.loads(before.schema))[before.key].dataType
    marks = keys.select(F.col(P.quoted(keys.columns[0])).cast(kind).alias("key")).na.drop().distinct()
    made = Batch(_batch_name(before.number + 1), batch, rows=False, marks=True)
    marks.write.parquet(_folder(root, "marks", made.name))
    applied = before.applied if batch is None else (*before.applied, batch)
    return _publish(
        spark,
        root,
        replace(before, number=before.number + 1, batches=(*before.batches, made), applied=applied),
    )


def _fitted(df: DataFrame, version: Version, evolve: bool) -> tuple[DataFrame, Version]:
    """The rows with the table's columns in its types, and the version with its schema, grown or not."""
    spark = df.sparkSession
    schema = StructType.fromJson(json.loads(version.schema))
    known = P.without_promoted(spark.createDataFrame([], schema))
    if not evolve:
        return in_columns_of(df, known), version
    plain = P.without_promoted(df)
    merged = spark.createDataFrame([], widened(known.schema, plain.schema))
    if merged.schema != known.schema:
        grown = laid_out(merged, version.layout)
        terms = version.terms_schema
        if version.posted:
            terms = postings(merged, version.key, version.posted, key_is_checked=True).schema.json()
        version = replace(version, schema=grown.schema.json(), terms_schema=terms)
    # By name at every depth; what is missing is null.
    return in_columns_of(merged.unionByName(plain, allowMissingColumns=True), merged), version


WIDER = [ByteType(), ShortType(), IntegerType(), LongType()]


def widened(a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both and that files of either can be read in.

    Integers widen to longer ones, floats to doubles, decimals of one scale to more digits, void to
    anything; structs are merged by name, array elements and map values likewise.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if a in WIDER and b in WIDER:
        return WIDER[max(WIDER.index(a), WIDER.index(b))]
    if {type(a), type(b)} == {FloatType, DoubleType}:
        return DoubleType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType) and a.scale == b.scale:
        return DecimalType(max(a.precision, b.precision), a.scale)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, MapType) and isinstance(b, MapType) and a.keyType == b.keyType:
        return MapType(a.keyType, widened(a.valueType, b.valueType))
    if isinstance(a, StructType) and isinstance(b, StructType):
        theirs = {f.name: f for f in b.fields}
        fields = [
            StructField(f.name, widened(f.dataType, theirs[f.name].dataType), True, f.metadata)
            if f.name in theirs
            else StructField(f.name, f.dataType, True, f.metadata)
            for f in a.fields
        ]
        own = set(a.names)
        more = [StructField(f.name, f.dataType, True, f.metadata) for f in b.fields if f.name not in own]
        return StructType([*fields, *more])
    raise TypeError(f"{a.simpleString()} and {b.simpleString()} have no common wider type")


# Summaries


def _value_names(i: int) -> dict[str, str]:
    return {kind: f"__v{i}_{kind}" for kind in ("n", "min", "max", "sum")}


def _partial(rows: DataFrame, summary: Summary) -> DataFrame:
    """Partial aggregates of some rows, one row per group."""
    keys = [P.path_column(rows, p).alias(f"__k{i}") for i, p in enumerate(summary.by)]
    values = [P.path_column(rows, p).alias(f"__v{i}") for i, p in enumerate(summary.values)]
    aggs = [F.count(F.lit(1)).alias("__n")]
    chosen = rows.select(*keys, *values)
    for i, _ in enumerate(values):
        names, v = _value_names(i), F.col(f"__v{i}")
        aggs += [F.count(v).alias(names["n"]), F.min(v).alias(names["min"])]
        aggs.append(F.max(v).alias(names["max"]))
        if isinstance(chosen.schema[f"__v{i}"].dataType, NumericType):
            aggs.append(F.sum(v).alias(names["sum"]))
    return chosen.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(*aggs)


def read_summary(
    spark: SparkSession, root: str, name: str, number: int | None = None
) -> DataFrame:
    """A summary of a version: its keys, ``n``, and ``n_``, ``min_``, ``max_`` of each value.

    Numbers have ``sum_`` as well.

    Stored partial aggregates are merged and no row is read, except those of batches older than the
    newest delete mark, which least and largest values cannot be taken back from: they are aggregated
    anew until ``compact_batches`` folds the marks in. Columns are named after the last steps of their
    paths. A table without groups gives one row for a summary without keys.
    """
    version = table_version(spark, root, number)
    summary = next((s for s in version.summaries if s.name == name), None)
    if summary is None:
        raise ValueError(f"no summary {name}; there are {[s.name for s in version.summaries]}")
    newest = max(version.names("marks"), default="")
    names = version.names("rows")
    clean, dirty = [n for n in names if n >= newest], [n for n in names if n < newest]
    shape = _partial(_stored_rows(spark, root, version, []), summary).schema
    with_batch = StructType.fromJson(shape.jsonValue()).add(BATCH, StringType())
    stored = spark.read.schema(with_batch).parquet(f"{root.rstrip('/')}/sums-{name}")
    parts = stored.filter(F.col(BATCH).isin(clean)).drop(BATCH)
    if dirty:
        parts = parts.unionByName(_partial(_visible(spark, root, version, dirty), summary))
    out: list[Column] = [F.sum("__n").alias("n")]
    if not summary.by:
        out = [F.coalesce(F.sum("__n"), F.lit(0)).alias("n")]
    for i, path in enumerate(summary.values):
        last, parts_of = P.steps(path)[-1], _value_names(i)
        n = F.sum(parts_of["n"])
        out.append((n if summary.by else F.coalesce(n, F.lit(0))).alias(f"n_{last}"))
        for kind, merge in (("min", F.min), ("max", F.max), ("sum", F.sum)):
            if parts_of[kind] in parts.columns:
                out.append(merge(parts_of[kind]).alias(f"{kind}_{last}"))
    keys = [F.col(f"__k{i}").alias(P.steps(p)[-1]) for i, p in enumerate(summary.by)]
    return parts.groupBy(*keys).agg(*out)


# Compaction


@dataclass(frozen=True)
class StoredFile:
    """A data file: its path as the reader names it, its batch, partition folder and size in bytes."""

    path: str
    batch: str
    folder: str
    size: int


def version_files(
    spark: SparkSession, root: str, number: int | None = None
) -> list[StoredFile]:
    """The data files of a version with their sizes. They are listed as for reading, not opened."""
    return _row_files(spark, root, table_version(spark, root, number))


def _row_files(spark, root: str, version: Version) -> list[StoredFile]:
    top = f"{root.rstrip('/')}/rows"
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(top)
        .select("_metadata.file_path", "_metadata.file_size")
    )
    live, files = set(version.names("rows")), []
    for path, size in listed.collect():
        batch, _, rest = path.rsplit(f"/{BATCH}=", 1)[1].partition("/")
        if batch in live:
            files.append(StoredFile(path, batch, rest.rpartition("/")[0], size))
    return files


def first_fit(sizes: Sequence[int], capacity: int) -> list[int]:
    """The bin of each size: largest first, each into the first bin with room.

    Bins are found through a tree of the largest room below each node, so a file costs the logarithm of
    the number of bins.
    """
    leaves = 1
    while leaves < max(len(sizes), 1):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        need, node = min(sizes[i], capacity), 1
        while node < leaves:
            node = 2 * node if room[2 * node] >= need else 2 * node + 1
        bins[i] = node - leaves
        room[node] -= need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins


def compact_batches(
    spark: SparkSession, root: str, *, small_bytes: int = 64 << 20, target_bytes: int = 256 << 20
) -> Version:
    """Rewrite batches of small files as one, fold delete marks in, and publish the result.

    Batches whose files are on average smaller than ``small_bytes`` are rewritten, and every batch that
    marks reach into; others stay as they are. The files of each partition are packed by first fit over
    their measured sizes, and every bin becomes one file, written by one task. Older versions still read
    the files they name. With nothing to do the version stays.
    """
    if not 0 < small_bytes <= target_bytes:
        raise ValueError("small_bytes is positive and at most target_bytes")
    before = table_version(spark, root)
    files = _row_files(spark, root, before)
    newest = max(before.names("marks"), default="")
    sizes: dict[str, list[int]] = {n: [] for n in before.names("rows")}
    for f in files:
        sizes[f.batch].append(f.size)
    small = {n for n, s in sizes.items() if sum(s) < small_bytes * max(len(s), 1)}
    # A mark may hide rows of any older batch, so marks only go when all of those are rewritten.
    moved = sorted(small | {n for n in sizes if n < newest})
    if not newest and (len(moved) < 2 or not _shrinks(files, moved, target_bytes)):
        return before
    packed = [f for f in files if f.batch in moved]
    bins = _bins(packed, target_bytes)
    rows = _visible(spark, root, before, moved, files=True)
    name = _batch_name(before.number + 1)
    _write_packed(rows, root, before, name, bins)
    if before.posted or before.summaries:
        fresh = _stored_rows(spark, root, before, [name])
        if before.posted:
            terms = postings(fresh, before.key, before.posted, key_is_checked=True)
            write_postings(terms, _folder(root, "terms", name))
        for summary in before.summaries:
            _partial(fresh, summary).write.parquet(_folder(root, f"sums-{summary.name}", name))
    kept = [replace(b, marks=False) for b in before.batches if b.rows and b.name not in moved]
    after = replace(before, number=before.number + 1, batches=(*kept, Batch(name)))
    return _publish(spark, root, after)


def _bins(files: Sequence[StoredFile], target_bytes: int) -> dict[str, int]:
    """A bin number for every file; files of different partitions never share one."""
    by_folder: dict[str, list[StoredFile]] = {}
    for f in files:
        by_folder.setdefault(f.folder, []).append(f)
    found, start = {}, 0
    for folder in sorted(by_folder):
        group = by_folder[folder]
        bins = first_fit([f.size for f in group], target_bytes)
        found |= {f.path: start + b for f, b in zip(group, bins, strict=True)}
        start += max(bins) + 1
    return found


def _shrinks(files: Sequence[StoredFile], moved: Sequence[str], target_bytes: int) -> bool:
    packed = [f for f in files if f.batch in moved]
    return len(set(_bins(packed, target_bytes).values())) < len(packed)


def _write_packed(
    rows: DataFrame, root: str, version: Version, name: str, bins: dict[str, int]
) -> None:
    """Write every bin from one task, so that its rows become one file."""
    listed = rows.sparkSession.createDataFrame(list(bins.items()), f"{PATH} string, __bin int")
    columns = [P.quoted(c) for c in rows.columns if c != PATH]
    n_bins = max(bins.values(), default=0) + 1
    packed = rows.join(listed, PATH).repartitionById(n_bins, F.col("__bin")).select(*columns)
    save_laid_out(packed, _folder(root, "rows", name), version.layout, "errorifexists")


def vacuum(spark: SparkSession, root: str, *, keep: int = 1) -> list[str]:
    """Remove folders that none of the newest ``keep`` versions names, and the older versions.

    Readers of older versions and writers that have not published yet lose their files: run it when
    there are none. The older version files go first, so that no version names a missing folder.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    numbers = version_numbers(spark, root)
    live = {
        b.name for n in numbers[-keep:] for b in table_version(spark, root, n).batches
    }
    for number in numbers[:-keep]:
        remove_path(spark, _version_path(root, number))
    gone = []
    for kind in child_names(spark, root):
        if kind == "versions":
            continue
        for name in child_names(spark, f"{root.rstrip('/')}/{kind}"):
            if name.startswith(f"{BATCH}=") and name.split("=", 1)[1] not in live:
                remove_path(spark, f"{root.rstrip('/')}/{kind}/{name}")
                gone.append(f"{kind}/{name}")
    return gone
