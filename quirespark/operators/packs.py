"""Names of a pack that stand in texts, by one automaton over the pack."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of a pack at most: packs are dimensions of fixed size, and what grows with the data is none.
PACK_NAMES = 500_000


def standing(df: DataFrame, text: str, pack: DataFrame, name: str) -> DataFrame:
    """Rows of ``df`` with ``name``, once for each distinct name of ``pack`` that stands anywhere in ``text``, as written.

    The names are collected (an error beyond ``PACK_NAMES``), broadcast once and
    compiled once a task; a text is read once, however many names there are.
    NULL and empty texts and names match nothing.
    """
    rows = pack.where(F.length(name) > 0).select(name).distinct().limit(PACK_NAMES + 1).collect()
    if len(rows) > PACK_NAMES:
        raise ValueError(f"a pack holds more than {PACK_NAMES} names")
    names = df.sparkSession.sparkContext.broadcast(sorted(r[0] for r in rows))
    at, columns = df.columns.index(text), [*df.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for n in names.value:
            automaton.add_word(n, n)
        automaton.make_automaton()
        for batch in batches:
            places, found = [], []
            for k, value in enumerate(batch.column(at).to_pylist() if names.value else ()):
                if value:
                    hits = {n for _, n in automaton.iter(value)}
                    places += [k] * len(hits)
                    found += sorted(hits)
            own = batch.take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found, pa.string())], columns)

    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + f", `{name}` string"
    return df.mapInArrow(run, schema)
