"""facetframe: search, facet and aggregate tables with nested columns on PySpark.

Every operator takes and returns DataFrames built from the DataFrame and SQL API, so Catalyst
plans them and Spark runs them. Only the functions in ``sources.tables`` and the writers in
``operators.postings`` store data.
"""

from facetframe.functions.paths import path_column, path_type, promote, where, without_promoted
from facetframe.functions.predicates import contains_value, has_key, has_token, key_equals, words
from facetframe.operators import bits
from facetframe.operators.bits import read_bit_postings, write_bit_postings
from facetframe.operators.facets import facet, group_paths
from facetframe.operators.grams import (
    lookup_containing,
    lookup_suffix,
    read_grams,
    term_grams,
    terms_containing,
    terms_ending,
    write_grams,
)
from facetframe.operators.joins import in_keys
from facetframe.operators.paging import has_next, page, page_after
from facetframe.operators.postings import (
    append_rows,
    facet_from_counts,
    facet_from_postings,
    postings,
    read_postings,
    save_searchable,
    term_counts,
    upserted_postings,
    write_postings,
)
from facetframe.operators.profile import path_profile
from facetframe.operators.ranks import (
    has_next_by_index,
    page_by_index,
    read_rank_index,
    write_rank_index,
)
from facetframe.operators.search import (
    existing_keys,
    exists,
    lookup,
    lookup_all,
    lookup_any,
    lookup_keys,
    lookup_not,
    lookup_prefix,
    lookup_range,
    missing,
)
from facetframe.operators.text import token_filter
from facetframe.operators.upsert import upsert
from facetframe.operators.variants import (
    promote_variant,
    variant_present,
    variant_profile,
    variant_type,
    variant_value,
    with_variant,
)
from facetframe.sources.tables import Layout, compact, read_table, stored_layout, write_table
from facetframe.sources.versions import (
    Summary,
    append_batch,
    compact_batches,
    create_versioned,
    delete_batch,
    read_summary,
    read_versioned,
    table_version,
    upsert_batch,
    vacuum,
    version_files,
    versioned_postings,
)

__all__ = [
    "Layout",
    "Summary",
    "append_batch",
    "append_rows",
    "bits",
    "compact",
    "compact_batches",
    "contains_value",
    "create_versioned",
    "delete_batch",
    "existing_keys",
    "exists",
    "facet",
    "facet_from_counts",
    "facet_from_postings",
    "group_paths",
    "has_key",
    "has_next",
    "has_next_by_index",
    "has_token",
    "in_keys",
    "key_equals",
    "lookup",
    "lookup_all",
    "lookup_any",
    "lookup_containing",
    "lookup_keys",
    "lookup_not",
    "lookup_prefix",
    "lookup_range",
    "lookup_suffix",
    "missing",
    "page",
    "page_after",
    "page_by_index",
    "path_column",
    "path_profile",
    "path_type",
    "postings",
    "promote",
    "promote_variant",
    "read_bit_postings",
    "read_grams",
    "read_postings",
    "read_rank_index",
    "read_summary",
    "read_table",
    "read_versioned",
    "save_searchable",
    "stored_layout",
    "table_version",
    "term_counts",
    "term_grams",
    "terms_containing",
    "terms_ending",
    "token_filter",
    "upsert",
    "upsert_batch",
    "upserted_postings",
    "vacuum",
    "variant_present",
    "variant_profile",
    "variant_type",
    "variant_value",
    "version_files",
    "versioned_postings",
    "where",
    "with_variant",
    "without_promoted",
    "words",
    "write_bit_postings",
    "write_grams",
    "write_postings",
    "write_rank_index",
    "write_table",
]
