"""Substring deduplication by hashing units of text.

A text is cut at line breaks and sentence ends into units; each unit's normal
form has a digest, and of all units with a digest the first in the order of
(document, unit) stays. Repeated units that follow each other form passages,
which are reported with their offsets in the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalis.llm.common import id_text, named, slices, write_table

#: A unit with the marks that end it; the units of a text make up the text.
UNIT = re.compile(r"[^.!?。！？\n]*[.!?。！？\n]+|[^.!?。！？\n]+")
#: Scripts written without blanks (Thai and Lao, kana, Han): a character is a word.
UNSPACED = "\u0e00-\u0eff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
WORD = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")


def units(text: str) -> Iterator[tuple[int, int, int, bytes]]:
    """Start, end, words and digest of the units that hold a word."""
    for m in UNIT.finditer(text):
        words = WORD.findall(m[0].lower())
        if words:
            yield m.start(), m.end(), len(words), hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        out: list[list] = [[] for _ in range(6)]
        for i, text in zip(named(part, "doc_id").to_pylist(), named(part, "text").to_pylist()):
            for k, u in enumerate(units(text)):
                for c, v in zip(out, (i, k, *u)):
                    c.append(v)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                         ["doc_id", "unit", "start", "end", "words", "digest"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      passage_words: int = 16) -> DataFrame:
    """``doc_id, start, end, n_units, n_words, first_doc_id`` for every passage
    to remove: a run of units that each occurred before.

    Every unit with a word counts, however short, and a unit that did not occur
    before ends a run, so nothing unique lies inside a passage; marks and blanks
    without a word go along. Runs of fewer than ``passage_words`` words stay, as
    short units repeat by chance ("No."); 1 reports every repeated unit. In
    scripts without blanks a character counts as a word. ``start`` and ``end``
    are offsets in code points of the original text; ``first_doc_id`` is where
    the run's first unit stays.

    Digests are grouped with partial minima, and only units whose digest occurs
    twice are joined back and ordered by document, so neither a frequent unit
    nor a long text is gathered with the rest of its kind.

    Null and empty texts have no units. A row with a null id takes no part.
    Rows that repeat an id are read as one document: units with the same number
    tie, and all of them stay if one does. No documents: no rows. Other
    columns are ignored.
    """
    rows = id_text(docs, id_col, text_col).where("doc_id is not null")
    found = write_table(rows.mapInArrow(_units, "doc_id long, unit int, start int, end int, words int, digest binary"), "units")
    # Written, so that Spark can split the occurrences of a frequent unit.
    first = write_table(found.groupBy("digest").agg(F.min(F.struct("doc_id", "unit")).alias("first"), F.count("*").alias("n"))
                        .where("n > 1").select("digest", "first"), "unit-firsts")
    again = (found.join(first, "digest").where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("unit") != F.col("first.unit")))
             .select("doc_id", "unit", "start", "end", "words", F.col("first.doc_id").alias("first_doc_id")).distinct())
    run = again.withColumn("run", F.col("unit") - F.dense_rank().over(Window.partitionBy("doc_id").orderBy("unit")))
    return (run.groupBy("doc_id", "run")
            .agg(F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"), F.count("*").alias("n_units"),
                 F.sum("words").alias("n_words"), F.min_by("first_doc_id", "unit").alias("first_doc_id"))
            .where(F.col("n_words") >= passage_words).drop("run"))


#: The same in SQL, for the default parameters.
PASSAGES_SQL = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(text, '[^.!?。！？\n]*[.!?。！？\n]+|[^.!?。！？\n]+') AS u FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), each AS (
  SELECT doc_id, u[k] AS t, k, regexp_extract_all(regexp_replace(lower(u[k]), '([UNSPACED])', ' \1 ', 'g'), '[UNSPACED]|[\p{L}\p{N}_]+') AS w
  FROM (SELECT doc_id, u, unnest(range(1, len(u) + 1)) AS k FROM cut)
), placed AS (
  SELECT doc_id, k, array_to_string(w, ' ') AS form, len(w) AS words,
    CAST(sum(length(t)) OVER (PARTITION BY doc_id ORDER BY k) AS BIGINT) AS "end", length(t) AS size FROM each
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS unit FROM placed WHERE words > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY form ORDER BY doc_id, unit) AS seen,
    first_value(doc_id) OVER (PARTITION BY form ORDER BY doc_id, unit) AS first_doc_id FROM numbered
), again AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM ranked WHERE seen > 1
)
SELECT doc_id, min("end" - size) AS start, max("end") AS "end", count(*) AS n_units, CAST(sum(words) AS BIGINT) AS n_words,
  arg_min(first_doc_id, unit) AS first_doc_id
FROM again GROUP BY doc_id, run HAVING sum(words) >= 16
""".replace("UNSPACED", UNSPACED)
