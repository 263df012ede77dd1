"""The main text of web pages: every block of a page judged by a recurrent labeller.

The page is read into its leaf blocks (`page_blocks`), which the labeller (`page_labeller`)
classifies with the whole page in view. Blocks of the main text are joined by an empty
line, in page order. Runs in one stage, without a shuffle.

Defined cases: a null page is an empty one; a page without main text gives an empty text;
white space inside a block (no-break spaces included) becomes one space; a long page is
read whole, a sequence of its own; repeated rows get equal texts; an empty table gives no
rows; other columns pass unchanged, and one called like the new column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import page_blocks, page_labeller
from .common import text_of
from .page_labeller import Weights
from .words import slices


def texts(pages: list[str], weights: Weights) -> list[str]:
    read = [page_blocks.read(p) for p in pages]
    scored = page_labeller.scores(weights, [page_labeller.features(p) for p in read])
    return ["\n\n".join([b.text for b, s in zip(p.blocks, found, strict=True) if s > 0]) for p, found in zip(read, scored, strict=True)]


def main_text(html: Column | str, weights: Weights | None = None) -> Column:
    """The main text of a page."""
    weights = weights or page_labeller.trained()

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([text for some in slices(batch) for text in texts(some.to_pylist(), weights)], pa.string())

    return extracted(text_of(html))


def labelled_blocks(html: Column | str, weights: Weights | None = None) -> Column:
    """All blocks of a page with the names of the elements above them and their score, above 0 for main text."""
    weights = weights or page_labeller.trained()

    @F.arrow_udf("array<struct<text: string, path: string, score: float>>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("path", pa.string()), ("score", pa.float32())]))
        for batch in batches:
            rows = []
            for some in slices(batch):
                read = [page_blocks.read(p) for p in some.to_pylist()]
                found = page_labeller.scores(weights, [page_labeller.features(p) for p in read])
                rows += [
                    [{"text": b.text, "path": _path(p, b.node), "score": float(s)} for b, s in zip(p.blocks, scores, strict=True)]
                    for p, scores in zip(read, found, strict=True)
                ]
            yield pa.array(rows, kind)

    return judged(text_of(html))


def _path(page: page_blocks.Page, node: int) -> str:
    names = []
    while node >= 0:
        names.append(page.nodes[node].tag)
        node = page.nodes[node].parent
    return "/".join(reversed(names))


def with_main_text(df: DataFrame, html: str = "html", text: str = "text", weights: Weights | None = None) -> DataFrame:
    return df.withColumn(text, main_text(html, weights))
