"""Section carry-forward over ordered text lines.

The reference turns one captured text into (Category, Detail) rows: a trimmed
line ending in ``:`` opens a section (its name = the line without any ``:``),
blank lines are skipped, lines before the first header belong to
``"General"``.  Re-aimed at tables of texts: lines come from ``posexplode``
of each row's text, the current header is ``last(header, ignorenulls)`` over a
window partitioned by the document key(s) and ordered by position.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import checkpointed

DEFAULT_SECTION = "General"


def _strip(c):
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def sectionize(df: DataFrame, doc_keys: Sequence[str], order_cols: Sequence[str], text_col: str,
               category: str = "Category", detail: str = "Detail", line_no: str = "line_no",
               default: str = DEFAULT_SECTION) -> DataFrame:
    """(doc_keys, order_cols, line_no, Category, Detail) for every non-blank,
    non-header line.  ``doc_keys`` partition the carry-forward: pass the
    finest key that still starts with a header line (e.g. a conversation turn
    that always opens with its role header) so a huge document is not one
    window partition; ``sectionize_rows`` carries on across the rows of a document of any length."""
    lines = (df.select(*doc_keys, *[c for c in order_cols if c not in doc_keys],
                       F.posexplode(F.split(F.col(text_col), "\n")).alias(line_no, "__line"))
             .withColumn("__s", _strip(F.col("__line"))))
    is_header = F.col("__s").endswith(":")
    lines = lines.withColumn("__h", F.when(is_header, F.regexp_replace("__s", ":", "")))
    w = (Window.partitionBy(*doc_keys).orderBy(*[c for c in order_cols if c not in doc_keys], line_no)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lines = lines.withColumn(category, F.coalesce(F.last("__h", ignorenulls=True).over(w), F.lit(default)))
    keep = [c for c in order_cols if c not in doc_keys]
    return (lines.where(~is_header & (F.col("__s") != ""))
            .select(*doc_keys, *keep, line_no, category, F.col("__s").alias(detail)))


def sectionize_rows(df: DataFrame, doc_keys: Sequence[str], order_cols: Sequence[str], text_col: str,
                    category: str = "Category", detail: str = "Detail", line_no: str = "line_no",
                    default: str = DEFAULT_SECTION) -> DataFrame:
    """``sectionize`` for documents that arrive as many rows, in the order of ``order_cols`` (NULLs first; no two rows of a
    document alike in them): a header carries on into the rows that follow.

    A segmented scan.  Rows are range-partitioned by document and order, so a long document lies in several
    partitions.  Each row gives its last header; a partition's rows take the last one before them in the
    partition, or what its part of the document was handed: the last header of the parts
    before, from one row a partition and document.  Lines never leave their row.  The partitioned rows are
    checkpointed (a job runs), since both passes must see the same parts."""
    keys, order = list(doc_keys), [c for c in order_cols if c not in doc_keys]
    header = lambda x: F.when(_strip(x).endswith(":"), F.regexp_replace(_strip(x), ":", ""))
    rows = (df.select(*keys, *order, F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("__lines"))
            .withColumn("__heads", F.filter(F.sequence(F.lit(0), F.size("__lines") - 1), lambda i: header(F.get("__lines", i)).isNotNull()))
            .withColumn("__last", header(F.get("__lines", F.try_element_at("__heads", F.lit(-1)))))
            .repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()))
    rows = checkpointed(rows)
    by_part = [*keys, "__part"]
    # what each part of a document ends with, and what the parts before it hand on
    ends = rows.groupBy(*by_part).agg(F.max_by("__last", F.when(F.col("__last").isNotNull(), F.struct(*order))).alias("__end"))
    handed = (ends.withColumn("__handed", F.last("__end", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
              .where(F.col("__handed").isNotNull()).select(*[F.col(c).alias(f"__h_{c}") for c in by_part], "__handed"))
    same = F.lit(True)
    for c in by_part:
        same = same & F.col(c).eqNullSafe(F.col(f"__h_{c}"))
    inside = Window.partitionBy(*by_part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    opened = (rows.withColumn("__before", F.last("__last", ignorenulls=True).over(inside)).join(handed, same, "left")
              .withColumn("__open", F.coalesce("__before", "__handed", F.lit(default))))
    # a row's sections: from the row's start and from each header to the next
    starts = F.concat(F.array(F.lit(-1)), F.col("__heads"))
    sections = F.transform(starts, lambda at, k: F.struct(
        (at + 1).alias("first"), F.when(at < 0, F.col("__open")).otherwise(header(F.get("__lines", at))).alias("name"),
        F.slice("__lines", at + 2, F.coalesce(F.get(starts, k + 1), F.size("__lines")) - at - 1).alias("lines")))
    found = (opened.select(*keys, *order, F.explode(sections).alias("__s"))
             .select(*keys, *order, "__s.first", "__s.name", F.posexplode("__s.lines").alias("__k", "__line")))
    return (found.select(*keys, *order, (F.col("first") + F.col("__k")).alias(line_no), F.col("name").alias(category), _strip(F.col("__line")).alias(detail))
            .where(F.col(detail) != ""))
