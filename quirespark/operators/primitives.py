"""The flat table of page primitives that the layout operators work on.

``doc_id, page_number, kind, prim_ord, primitive_id, x0, y0, x1, y1`` with
``text, line_count, font_name, font_size, is_bold, is_italic`` for texts,
``content_hash`` for images, ``rows, cols, cell_count, extraction_strategy`` for
tables and ``path_count, is_decorative`` for drawings; columns of other kinds are NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Column and type of everything that only some kinds have.
OPTIONAL = {
    "text": "string", "line_count": "int", "font_name": "string", "font_size": "double", "is_bold": "boolean", "is_italic": "boolean",
    "content_hash": "string", "rows": "int", "cols": "int", "cell_count": "int", "extraction_strategy": "string", "path_count": "int", "is_decorative": "boolean",
}


def complete(df: DataFrame) -> DataFrame:
    """Adds missing kind-specific columns as NULL."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in OPTIONAL.items() if c not in df.columns})


def from_text_table(texts: DataFrame) -> DataFrame:
    """Primitives of kind ``text``; repeated rows count once, ``prim_ord`` is the number at the end of the id."""
    cols = ["doc_id", "page_number", "primitive_id", "text", "line_count", "font_name", "font_size", "is_bold", "is_italic"]
    flat = texts.select(*cols, *[F.col(f"bbox_norm.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")])
    # Partitioned by page before repeats are dropped: windows and aggregates of pages need no other shuffle.
    flat = flat.repartition("doc_id", "page_number").distinct()
    return complete(flat.withColumns({"kind": F.lit("text"), "prim_ord": F.element_at(F.split("primitive_id", ":"), -1).cast("int")}))
