"""Writing, reading and compacting nested tables as Parquet.

A table keeps its layout beside its files (``_layout.json``, which listings of data skip): the columns
it is partitioned by, the paths it is sorted by, promoted and filtered by. Every later append follows
it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, fields
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from facetframe.functions import paths as P
from facetframe.sources.files import path_exists, read_text, write_text

LAYOUT_FILE = "_layout.json"
#: Bytes of Parquet that one task of a compaction sorts; in memory they are many times as many.
RANGE_BYTES = 32 << 20


@dataclass(frozen=True)
class Layout:
    """How the files of a table are laid out."""

    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    promote: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()

    @staticmethod
    def of(parts: dict) -> Layout:
        return Layout(**{f.name: tuple(parts.get(f.name, ())) for f in fields(Layout)})


def stored_layout(spark: SparkSession, path: str) -> Layout | None:
    """The layout a table was written with.

    For tables written by other means it is read off the folders and the metadata of the columns;
    None where there is no table.
    """
    kept = f"{path.rstrip('/')}/{LAYOUT_FILE}"
    if path_exists(spark, kept):
        return Layout.of(json.loads(read_text(spark, kept)))
    if not path_exists(spark, path):
        return None
    table = spark.read.parquet(path)
    promoted = tuple(P.promoted_columns(table))
    return Layout(partition_by=tuple(partition_columns(spark, path)), promote=promoted)


def _followed(asked: Layout, kept: Layout, path: str) -> Layout:
    """The kept layout; what is asked for must be part of it."""
    for field in fields(Layout):
        wanted, known = getattr(asked, field.name), getattr(kept, field.name)
        if field.name != "partition_by":
            wanted, known = tuple(map(P.identity, wanted)), tuple(map(P.identity, known))
        differs = set(wanted) - set(known) if field.name in ("promote", "bloom") else wanted != known
        if wanted and differs:
            raise ValueError(f"{path} has {field.name} {known}, not {wanted}")
    return kept



def _shadows(df: DataFrame, paths: Iterable[str]) -> list[str]:
    """Top-level columns for paths: their shadow columns, or the columns themselves."""
    known = P.promoted_columns(df)
    return [known.get(P.identity(p)) or P.steps(p)[0] for p in paths]


def _writer(df: DataFrame, mode: str, bloom: Iterable[str]) -> DataFrameWriter:
    writer = df.write.mode(mode)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    promote: Sequence[str] = (),
    bloom: Sequence[str] = (),
) -> None:
    """Write a nested table so that filters on chosen paths can be pushed to the reader.

    ``promote`` adds shadow columns for map keys and struct fields, ``sort_by`` (paths) orders the
    rows within each task for tight row-group statistics, ``bloom`` (paths) adds bloom filters.
    Nested paths to sort by or to filter are promoted as well, since Parquet needs them on top.
    Output that is neither partitioned nor sorted is written where the rows are, without a shuffle.
    With ``partition_by`` the rows are rebalanced first: small partitions share files no more, and a
    partition holding much of the data is split over many tasks by adaptive execution. With
    ``sort_by`` alone they are rebalanced by the sorted columns, so that what a task sorts is bounded.

    Appending to a stored table follows the layout it was written with, so the rows lie where its
    readers look for them and promoted paths stay promoted; a different layout is refused, and so are
    rows without the table's columns.
    """
    layout = Layout(*map(tuple, (partition_by, sort_by, promote, bloom)))
    kept = stored_layout(df.sparkSession, path) if mode == "append" else None
    if kept is not None:
        layout = _followed(layout, kept, path)
        df = in_columns_of(df, read_table(df.sparkSession, path))
    left_alone = mode == "ignore" and path_exists(df.sparkSession, path)
    write_rows(df, path, layout, mode)
    if kept is None and not left_alone:
        write_text(df.sparkSession, f"{path.rstrip('/')}/{LAYOUT_FILE}", json.dumps(asdict(layout)))


def in_columns_of(df: DataFrame, table: DataFrame) -> DataFrame:
    """The rows with the table's columns in its types. Promoted columns are derived anew later."""
    plain = P.without_promoted(df)
    shadows = set(P.promoted_columns(table).values())
    wanted = [f for f in table.schema.fields if f.name not in shadows]
    lost = {f.name for f in wanted} ^ set(plain.columns)
    if lost:
        raise ValueError(f"the rows and the table differ in columns {sorted(lost)}")
    return plain.select(*[F.col(P.quoted(f.name)).cast(f.dataType).alias(f.name) for f in wanted])


def laid_out(df: DataFrame, layout: Layout) -> DataFrame:
    """The rows with the promoted columns of a layout; nested paths to sort or filter by are promoted."""
    nested = [p for p in [*layout.sort_by, *layout.bloom] if len(P.steps(p)) > 1]
    return P.promote(df, [*layout.promote, *nested])


def save_laid_out(table: DataFrame, path: str, layout: Layout, mode: str) -> None:
    """Write laid out rows from the tasks they are in, each task's rows in the order of the layout."""
    if layout.sort_by:
        order = [F.col(P.quoted(c)) for c in [*layout.partition_by, *_shadows(table, layout.sort_by)]]
        table = table.sortWithinPartitions(*order)
    writer = _writer(table, mode, _shadows(table, layout.bloom))
    writer.partitionBy(*layout.partition_by).parquet(path)


def write_rows(df: DataFrame, path: str, layout: Layout, mode: str) -> None:
    """Write rows in a layout, which is not recorded here."""
    table = laid_out(df, layout)
    together = layout.partition_by or dict.fromkeys(_shadows(table, layout.sort_by))
    if together:
        table = table.hint("rebalance", *map(P.quoted, together))
    save_laid_out(table, path, layout, mode)


def read_table(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None
) -> DataFrame:
    """Read one or several table paths. Promoted columns stay available to ``path_column``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a table is partitioned by, from the folders between its root and its files."""
    files = spark.read.parquet(path).inputFiles()
    if not files:
        return []
    folders = unquote(files[0]).rstrip("/").split("/")[:-1]
    found = []
    while folders and re.match(r"[^=]+=", folders[-1]):
        found.insert(0, folders.pop().split("=", 1)[0])
    return found


def _ranges(spark: SparkSession, path: str) -> int:
    """Ranges of at most ``RANGE_BYTES`` of a table, at most one for two of its files."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .agg(F.sum("_metadata.file_size"), F.count(F.lit(1)))
    )
    size, files = listed.head()
    return min(-(-(size or 0) // RANGE_BYTES), files // 2)


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    files: int,
    sort_by: Sequence[str] = (),
    *,
    partition_by: Sequence[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Rewrite the table at ``src`` into fewer files at ``dst``, keeping every row.

    Unpartitioned rows go into ``files`` files; where that gives a task more than ``RANGE_BYTES`` to
    sort, into more, but at most half as many as the source has. They are range-partitioned by ``sort_by`` and, within equal
    values, by their position in the source, so neither a frequent value nor many equal copies end
    up in one task. A partitioned table (``partition_by``, by default as the source is) keeps its
    layout: its rows are ranged by partition first, so a partition gets files by its share of rows.
    """
    if files < 1:
        raise ValueError("files must be at least 1")
    table = read_table(spark, src)
    if partition_by is None:
        partition_by = partition_columns(spark, src)
    columns = [P.quoted(c) for c in table.columns]
    layout = [F.col(P.quoted(c)) for c in partition_by]
    order = [*layout, *(F.col(P.quoted(c)) for c in _shadows(table, sort_by))]
    placed = table.withColumn("__position", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(max(files, _ranges(spark, src)), *order, "__position")
    if order:
        ranged = ranged.sortWithinPartitions(*order)
    ranged.select(*columns).write.mode(mode).partitionBy(*partition_by).parquet(dst)
