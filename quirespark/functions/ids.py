"""Readable identifiers and content fingerprints; all are pure expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_id(doc: Column, page: Column) -> Column:
    return F.format_string("%s:p%04d", doc, page)


def block_id(doc: Column, page: Column, number: Column, kind: Column) -> Column:
    return F.format_string("%s:p%04d:b%03d:%s", doc, page, number, kind)


def list_item_id(doc: Column, page: Column, block: Column, item: Column) -> Column:
    return F.format_string("%s:p%04d:b%03d:li%02d", doc, page, block, item)


def unit_id(doc: Column, page: Column, number: Column) -> Column:
    return F.format_string("%s:u%04d_%02d", doc, page, number)


def inline_id(block: Column, number: Column) -> Column:
    return F.format_string("%s:i%03d", block, number)


def asset_class_id(kind: Column, number: Column) -> Column:
    return F.format_string("asset:%s:%03d", kind, number)


def asset_occurrence_id(asset: Column, page: Column, number: Column) -> Column:
    return F.format_string("%s:p%04d:%02d", asset, page, number)


def primitive_id(kind: Column, page: Column, number: Column) -> Column:
    return F.format_string("%s:p%04d:%03d", kind, page, number)


def symbol_candidate_id(page: Column, number: Column) -> Column:
    return F.format_string("sym:p%04d:%03d", page, number)


def fingerprint(text: Column, length: int = 16) -> Column:
    """The first characters of the SHA-256 of a text."""
    return F.substring(F.sha2(text, 256), 1, length)


def page_fingerprint(text: Column, page: Column) -> Column:
    """Fingerprint of the texts of a page, which its number is part of."""
    return fingerprint(F.concat(page.cast("string"), F.lit(":"), text))


def row_hash(*columns: Column) -> Column:
    """SHA-256 of the JSON of the columns, in order of their names where they are sorted so; NULLs are left out."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def release_id(run: Column, doc: Column) -> Column:
    return F.concat(F.lit("rel-"), fingerprint(F.concat_ws(":", run, doc), 12))


def cache_key(parts: dict[str, Column]) -> Column:
    """SHA-256 of the sorted ``name=value`` pairs joined by a pipe."""
    pairs = [F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit(""))) for k, v in parts.items()]
    return F.sha2(F.array_join(F.array_sort(F.array(*pairs)), "|"), 256)


def issue_id(rule: Column, severity: Column, message: Column, page: Column, block: Column) -> Column:
    """Identifier of a quality issue: the same issue has the same one in every run."""
    parts = F.concat_ws(":", rule, severity, message, F.when(page.isNotNull(), F.concat(F.lit("p"), page.cast("string"))), block)
    return F.concat(F.lit("qa-"), fingerprint(parts, 12))
