"""Line dedup: lines that many documents share go, except in the last document holding them.

Main path: DataFrame functions only. Lines are exploded, normalised and hashed; documents
are counted per hash; positions of dropped lines come back to their document, which is put
together again by position.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import WHITE, join_spread, scratch_name
from tabwright.session import materialize


def line_key(line: Column) -> Column:
    """Line without white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def drop_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """``docs`` with common lines taken out of the text, plus line counts.

    A key of at least ``min_chars`` code points that is in at least ``min_docs`` documents
    loses all its lines except in the largest id holding it; there all stay. Documents are
    told apart by id: rows that repeat an id count once, and each is answered. A null id is
    one document, smaller than any other. A null text counts as one empty line and stays
    null; an empty text is one empty line. Other columns pass through, also ones named as
    the two counts (pass other names then). An empty table gives an empty table.
    """
    clash = {n_lines, n_dropped} & set(docs.columns)
    docs = docs.drop(*clash)
    row = scratch_name(docs, "_row")
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    known = docs.withColumn(row, F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)))
    lines = known.select(F.col(id_col).alias("id"), F.col(row).alias("row"), F.posexplode(split).alias("pos", "line"))
    keyed = lines.select("id", "row", "pos", line_key(F.col("line")).alias("key"))
    keyed = keyed.where(F.char_length("key") >= min_chars)
    # 128 bits stand for the key from here on
    keyed = materialize(
        keyed.select("id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")), "lines"
    )
    held = keyed.groupBy("h1", "h2", "id").agg(F.count(F.lit(1)).alias("times"))
    common = held.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("last"), F.sum("times").alias("lines")
    )
    common = materialize(common.where(F.col("n") >= min_docs).select("h1", "h2", "last", "lines"), "common")
    lost = join_spread(keyed, common, ["h1", "h2"], "lines").where(~F.col("id").eqNullSafe(F.col("last")))
    lost = lost.groupBy("id", "row").agg(F.collect_set("pos").alias("lost"))
    joined = known.alias("d").join(
        lost.alias("l"), F.col(f"d.{row}").eqNullSafe(F.col("l.row")) & F.col(f"d.{id_col}").eqNullSafe(F.col("l.id")), "left"
    )
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    count = F.size(split)
    out = joined.select(*names, F.col("l.lost").alias(row)).withColumn(n_lines, count.cast("long"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(row))
    text = F.concat_ws("\n", F.transform(kept, lambda i: F.element_at(split, i + 1)))
    return (
        out.withColumn(n_dropped, F.coalesce(F.size(row), F.lit(0)).cast("long"))
        .withColumn(n_dropped, F.when(F.col(row).isNull(), F.lit(0).cast("long")).otherwise(F.col(n_dropped)))
        .withColumn(text_col, F.when(F.col(row).isNull(), F.col(text_col)).otherwise(text))
        .drop(row)
    )
