"""Token counts of the sections of a document, by the offsets of one encoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverwatch.llm.common import bounded_batches, table
from riverwatch.llm.tokens import default_path, encoder


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines of a text; a line ends after its newline."""
    ends = np.cumsum([len(x) + 1 for x in text.split("\n")])
    ends[-1] -= 1
    return np.concatenate(([0], ends[:-1])), ends


def allocate(tok_start: np.ndarray, tok_end: np.ndarray, sec_start: np.ndarray,
             sec_end: np.ndarray) -> np.ndarray:
    """The section of each token, -1 for none.

    Sections are disjoint and ascending. The rule for a token that crosses a
    boundary: it belongs to the section that holds most of its characters, and
    of equals to the first. The interval join is a binary search of the first
    section that ends after the token's start, and a walk on while sections
    begin before its end.
    """
    if not len(sec_start):
        return np.full(len(tok_start), -1)
    at = np.searchsorted(sec_end, tok_start, side="right")
    best, most = np.full(len(tok_start), -1), np.zeros(len(tok_start), dtype=np.int64)
    while True:
        inside = np.minimum(at, len(sec_start) - 1)
        live = (at < len(sec_start)) & (sec_start[inside] < tok_end)
        if not live.any():
            return best
        shared = np.where(live, np.minimum(tok_end, sec_end[inside])
                          - np.maximum(tok_start, sec_start[inside]), 0)
        better = shared > most
        best, most = np.where(better, at, best), np.where(better, shared, most)
        at = np.where(live, at + 1, len(sec_start))


def attribute_tokens(docs: DataFrame, sections_col: str | None = None,
                     tokenizer: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, section, start, end, n_tokens): each document is encoded once, whole.

    ``sections_col`` holds an array of struct(start, end) in code points,
    ascending and disjoint; without it, a document's sections are its lines,
    each with its newline. Tokens outside all sections are counted in a row
    with section -1 and null ends, if there are any, so the counts of a
    document always sum up to its tokens.

    Nulls: a null text is empty and has one empty line (no tokens); a null
    list of sections has no sections. Empty tables give no rows, repeated rows
    are counted one by one, null ids are carried along. Other columns are not
    read. A token is allocated by ``allocate``'s rule.
    """
    path = tokenizer or default_path()
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            row, section, starts, ends, counts = [], [], [], [], []
            listed = b.column(2).to_pylist() if sections_col else None
            for i, text in enumerate(b.column(1)):
                t = text.as_py() or ""
                if listed is None:
                    s, e = line_sections(t)
                else:
                    given = listed[i] or []
                    s = np.array([x["start"] for x in given], dtype=np.int64)
                    e = np.array([x["end"] for x in given], dtype=np.int64)
                found = np.bincount(allocate(*enc.spans(t), s, e) + 1, minlength=len(s) + 1)
                if found[0]:
                    row.append(np.array([i]))
                    section.append(np.array([-1]))
                    starts.append(np.array([-1]))
                    ends.append(np.array([-1]))
                    counts.append(found[:1])
                row.append(np.full(len(s), i))
                section.append(np.arange(len(s)))
                starts.append(s)
                ends.append(e)
                counts.append(found[1:])
            flat = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64)
                    for x in (row, section, starts, ends, counts)]
            none = flat[1] < 0
            yield pa.record_batch(
                [b.column(0).take(pa.array(flat[0])), pa.array(flat[1].astype(np.int32)),
                 pa.array(flat[2], mask=none), pa.array(flat[3], mask=none), pa.array(flat[4])],
                names=["id", "section", "start", "end", "n_tokens"])

    columns = [F.col(id_col).alias("id"), F.col(text_col).alias("text")]
    if sections_col:
        columns.append(F.col(sections_col).alias("sections"))
    return docs.select(*columns).mapInArrow(
        run, f"id {kind}, section int, start long, end long, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribute_tokens(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
