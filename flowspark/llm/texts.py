"""Arrow jobs over whole texts: columns in, columns with results out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from flowspark.llm.common import python_ready
from flowspark.llm.hashing import Piece, pieces


def map_texts(
    docs: DataFrame, keep: Sequence[str], results: str, work: Callable[[Piece], Sequence], lower: bool = False,
    text: str = "text",
) -> DataFrame:
    """The columns ``keep`` of ``docs`` and those of the schema ``results``.

    ``work`` gets a piece of texts (nulls as empty) and gives one array per result
    column. Results replace kept columns of the same name.
    """
    python_ready(docs.sparkSession)
    added = _parse_datatype_string(results)
    names = {f.name.lower() for f in added}
    keep = [c for c in keep if c.lower() not in names]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    schema = StructType(list(kept.fields) + list(added.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(0), lower):
                rows = batch.slice(piece.first, piece.texts)
                found = [x if isinstance(x, pa.Array) else pa.array(x) for x in work(piece)]
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], *found], names=schema.names)

    return docs.select(F.col(text).alias("__text"), *[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)
