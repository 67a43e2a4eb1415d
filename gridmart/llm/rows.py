"""Per-text functions over Arrow batches: each row goes through whole, its results beside it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gridmart.llm.words import slices, texts_of

#: From the texts of a slice to one list (or array) per result column.
TextFunction = Callable[[list[bytes | None]], list]


def map_texts(
    docs: DataFrame, make: Callable[[], TextFunction], results: str, text: str = "text"
) -> DataFrame:
    """``row`` (all columns of ``docs``, whatever their names) and ``out`` (the struct ``results``).

    ``make`` is called once in each task and gives the function for slices of texts.
    """
    packed = docs.select(F.struct("*").alias("row"))
    schema = StructType().add("row", packed.schema["row"].dataType)
    out = StructType.fromDDL(results)
    schema = schema.add("out", out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = to_arrow_schema(out)
        function = make()
        for batch in batches:
            rows = batch.column(0)
            texts = texts_of(rows.field(text))
            for begin, end in slices(texts):
                values = function(texts[begin:end])
                arrays = [pa.array(v, type=f.type) for v, f in zip(values, fields, strict=True)]
                struct = pa.StructArray.from_arrays(arrays, fields=list(fields))
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(begin, end - begin), struct], names=["row", "out"]
                )
        pa.default_memory_pool().release_unused()

    return packed.mapInArrow(run, schema)
