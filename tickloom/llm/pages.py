"""Main text of raw pages, by the recurrent block labeller."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.blocks import blocks
from tickloom.llm.labeller import main_blocks, trained
from tickloom.llm.words import columns_for, frugal, groups, ship


def main_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Rows of `pages` with `text`, the main text, and `n_chars`, its code points.

    A page is cut into blocks at block elements; references are decoded and white space becomes one space. Blocks that
    the labeller takes for the article are joined by line ends in page order. Null, empty and broken pages give what text they
    have, empty if none; repeated rows are read one by one. Columns named `text` or `n_chars` are replaced;
    `keep` names the columns that are carried along, by default all but the page itself. A task holds one group of
    pages of a few megabytes or one longer page, and the vectors of a few thousand blocks."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(trained())
    carried = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars") and (keep is not None or c != html)]
    read, place, places = columns_for(html, carried)
    schema = T.StructType([pages.schema[c] for c in carried] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in groups(batch.column(place)):
                part = batch.slice(at, to - at)
                cut = [blocks(page) for page in part.column(place).to_pylist()]
                main = main_blocks(shared.value, cut)
                texts = ["\n".join(b.text for b, m in zip(page, flags) if m) for page, flags in zip(cut, main)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in places), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.fieldNames())

    return pages.select(*read).mapInArrow(frugal(task), schema)
