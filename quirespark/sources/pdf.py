"""Paged documents: what a PDF library's objects say, as rows.

All but the call that opens a document works on the library's dictionaries, and
``open_document`` can be given, so that nothing here needs the library itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .files import font_bits

BOX = ("x0", "y0", "x1", "y1")
SPANS = (
    "doc_id string, page_number int, block_index int, line_index int, span_index int, x0 double, y0 double, x1 double, y1 double, origin array<double>, text string, font_name string, font_size double, "
    "font_flags int, color int, is_bold boolean, is_italic boolean, is_monospace boolean, direction string"
)
IMAGES = "doc_id string, page_number int, image_index int, xref int, x0 double, y0 double, x1 double, y1 double, width_px int, height_px int, colorspace string, extension string, content_hash string"
PAGES = "doc_id string, page_number int, width_pt double, height_pt double, rotation int, char_count int, fonts_used array<string>, error string"
DOCUMENTS = "doc_id string, sha256 string, file_size_bytes bigint, page_count int, metadata map<string, string>, outline array<struct<level: int, title: string, page_number: int>>, error string"


def open_library(content: bytes) -> Any:
    """The document of a library that is imported where it is needed."""
    import pymupdf

    return pymupdf.open(stream=content, filetype="pdf")


def span_rows(page: dict) -> Iterator[dict]:
    """Spans with text of a page's dictionary; image blocks are left out, blocks keep their place among all."""
    for b, block in enumerate(page.get("blocks", ())):
        if block.get("type") != 0:
            continue
        for n, line in enumerate(block.get("lines", ())):
            direction = "ltr" if line.get("dir", (1.0, 0.0))[0] >= 0 else "rtl"
            for k, span in enumerate(s for s in line.get("spans", ()) if s.get("text")):
                flags = span.get("flags", 0)
                bold, italic, mono = font_bits(flags)
                yield {
                    "block_index": b, "line_index": n, "span_index": k, **dict(zip(BOX, map(float, span["bbox"]))), "origin": [float(x) for x in span["origin"]] if "origin" in span else None,
                    "text": span["text"], "font_name": span.get("font", "unknown"), "font_size": round(span.get("size", 0.0), 2), "font_flags": flags, "color": span.get("color", 0),
                    "is_bold": bold, "is_italic": italic, "is_monospace": mono, "direction": direction,
                }


def page_row(page: Any, number: int) -> dict:
    """Size of a page, what is written on it and in which fonts."""
    spans = list(span_rows(page.get_text("dict")))
    return {"page_number": number, "width_pt": float(page.rect.width), "height_pt": float(page.rect.height), "rotation": int(page.rotation), "char_count": sum(len(s["text"]) for s in spans), "fonts_used": sorted({s["font_name"] for s in spans}), "error": None}


def image_rows(doc: Any, page: Any) -> Iterator[dict]:
    """Pictures of a page, one row for each place where one stands; content is known by its hash."""
    for k, entry in enumerate(page.get_images(full=True)):
        xref = entry[0]
        raw = doc.extract_image(xref)
        for rect in page.get_image_rects(xref):
            yield {
                "image_index": k, "xref": xref, **dict(zip(BOX, map(float, (rect.x0, rect.y0, rect.x1, rect.y1)))), "width_px": raw.get("width", 0), "height_px": raw.get("height", 0),
                "colorspace": str(raw.get("cs-name", raw.get("colorspace", ""))), "extension": raw.get("ext", "png"), "content_hash": hashlib.sha256(raw["image"]).hexdigest(),
            }


def document_row(doc: Any, content: bytes) -> dict:
    """Hash, size, number of pages, metadata and outline of a document."""
    return {
        "sha256": hashlib.sha256(content).hexdigest(), "file_size_bytes": len(content), "page_count": doc.page_count, "metadata": {k: str(v) for k, v in (doc.metadata or {}).items() if v},
        "outline": [{"level": e[0], "title": e[1], "page_number": e[2]} for e in doc.get_toc()], "error": None,
    }


def _scan(spark: SparkSession, path: str, schema: str, rows: Callable[[Any, bytes, list[int] | None], Iterator[dict]], pages: list[int] | None, open_document: Callable[[bytes], Any]) -> DataFrame:
    names = [c.split(" ", 1)[0] for c in _columns(schema)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            # A document at a time: what is held is one file and its rows.
            for doc_id, content in zip(part["path"], part["content"]):
                try:
                    out = [{"doc_id": doc_id, **r} for r in rows(open_document(content), content, pages)]
                except Exception as e:  # noqa: BLE001
                    out = [{"doc_id": doc_id, "error": str(e)[:500]}] if "error" in names else []
                yield pd.DataFrame([[r.get(n) for n in names] for r in out], columns=names, dtype=object)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def _columns(schema: str) -> list[str]:
    """Column definitions of a schema; commas within types do not part them."""
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [c.strip() for c in out]


def _wanted(doc: Any, pages: list[int] | None) -> Iterator[int]:
    """Page numbers to read; other pages are never opened.  None of the wanted ones there is an error."""
    have = [n for n in range(1, doc.page_count + 1) if pages is None or n in pages]
    if pages is not None and not have:
        raise ValueError(f"none of the pages exists; the document has {doc.page_count}")
    return iter(have)


def documents(spark: SparkSession, path: str, open_document: Callable[[bytes], Any] = open_library) -> DataFrame:
    """A row a file; one that cannot be opened has an ``error`` and nothing else."""
    return _scan(spark, path, DOCUMENTS, lambda doc, content, _: iter([document_row(doc, content)]), None, open_document)


def pages(spark: SparkSession, path: str, wanted: list[int] | None = None, open_document: Callable[[bytes], Any] = open_library) -> DataFrame:
    """A row a page; a page that fails has an ``error``, and the others are read all the same."""

    def rows(doc: Any, _: bytes, some: list[int] | None) -> Iterator[dict]:
        for n in _wanted(doc, some):
            try:
                yield page_row(doc[n - 1], n)
            except Exception as e:  # noqa: BLE001
                yield {"page_number": n, "error": str(e)[:500]}

    return _scan(spark, path, PAGES, rows, wanted, open_document)


def _of_pages(read: Callable[[Any, Any], Iterator[dict]]) -> Callable[[Any, bytes, list[int] | None], Iterator[dict]]:
    def rows(doc: Any, _: bytes, some: list[int] | None) -> Iterator[dict]:
        for n in _wanted(doc, some):
            try:
                own = list(read(doc, doc[n - 1]))
            except Exception:  # noqa: BLE001
                continue  # :func:`pages` names it.
            for r in own:
                yield {"page_number": n, **r}

    return rows


def spans(spark: SparkSession, path: str, wanted: list[int] | None = None, open_document: Callable[[bytes], Any] = open_library) -> DataFrame:
    """Spans of all pages with their block and line; pages that fail give none."""
    return _scan(spark, path, SPANS, _of_pages(lambda _, page: span_rows(page.get_text("dict"))), wanted, open_document)


def images(spark: SparkSession, path: str, wanted: list[int] | None = None, open_document: Callable[[bytes], Any] = open_library) -> DataFrame:
    """Pictures of all pages; pages that fail give none."""
    return _scan(spark, path, IMAGES, _of_pages(image_rows), wanted, open_document)


PRIMITIVES = "doc_id string, page_number int, primitive_id string, prim_ord int, x0 double, y0 double, x1 double, y1 double, text string, font_name string, font_size double, is_bold boolean, is_italic boolean"


def primitive_rows(page: Any) -> Iterator[dict]:
    """Spans that are not blank, numbered through, with boxes in shares of the page."""
    width, height = page.rect.width or 1.0, page.rect.height or 1.0
    for k, s in enumerate(s for s in span_rows(page.get_text("dict")) if s["text"].strip()):
        yield s | {"prim_ord": k, "x0": s["x0"] / width, "y0": s["y0"] / height, "x1": s["x1"] / width, "y1": s["y1"] / height}


def primitives(spark: SparkSession, path: str, wanted: list[int] | None = None, open_document: Callable[[bytes], Any] = open_library) -> DataFrame:
    """Text primitives of all pages; pages that fail give none."""

    def rows(doc: Any, content: bytes, some: list[int] | None) -> Iterator[dict]:
        for r in _of_pages(lambda _, page: primitive_rows(page))(doc, content, some):
            yield r | {"primitive_id": f"text:p{r['page_number']:04d}:{r['prim_ord']:03d}"}

    return _scan(spark, path, PRIMITIVES, rows, wanted, open_document)
