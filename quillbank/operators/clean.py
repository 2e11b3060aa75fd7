"""Removal of ``<p>`` attributes from every string of a document.

The string literals of a JSON text are cut out where it stands, so all between them stays as it was.  Of the
values among them, those that may hold a ``<p`` with attributes are decoded and cleaned; a literal is replaced
only if its text changed.  Python sees these fragments and nothing else of a document.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.functions.html import P_WITH_MORE_IN_JSON, clean_fragments
from quillbank.functions.sql import case, lit
from quillbank.functions.variants import field
from quillbank.sources.documents import configure, parsed

# The string literals of a JSON text and what lies between them; possessive, so that a long one is matched without recursion.
PIECES = r'(?s)"(?:[^"\\]++|\\.)*+"|[^"]++'
# A literal whose escaped surrogates all come in pairs.
PAIRED = (r'(?s)^"(?:[^"\\]++|\\[^u]|\\u(?![dD][89a-fA-F]).{4}|\\u[dD][89abAB].{2}\\u[dD][c-fC-F].{2})*+"$')
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def base_folders(spark: SparkSession, base_path: str) -> list[str]:
    """The base folder as given and as the file system qualifies it, without scheme and host."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base_path)
    qualified = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    given = re.sub(SCHEME, "", base_path).rstrip("/")
    return list(dict.fromkeys([qualified.toUri().getPath().rstrip("/"), given]))


def relative_path(path: Column, folders: list[str]) -> Column:
    """``path`` below the first of ``folders`` that it starts with; a path outside of all stays whole.

    Whole segments are compared, so ``in`` is no folder of ``plugin/in/x`` and no two paths share a key.
    """
    local = F.regexp_replace(path, SCHEME, "")
    below = [F.when(F.startswith(local, F.lit(f + "/")), F.substring(local, len(f) + 2, 1 << 30)) for f in folders]
    return F.coalesce(*below, path)


def clean(documents: DataFrame, base_path: str = "") -> DataFrame:
    """Adds ``rel_path`` and ``cleaned_json``; the text is NULL for unreadable documents.

    A document is also unreadable if a cleaned fragment holds a lone surrogate, which no text can.
    """
    spark = configure(documents.sparkSession)
    rel_path = relative_path(F.col("path"), base_folders(spark, base_path)) if base_path else F.col("path")
    needed = f"raw RLIKE {lit(P_WITH_MORE_IN_JSON)}"
    df = documents.withColumns({
        "rel_path": rel_path,
        "readable": F.expr(f"({parsed('raw')}) IS NOT NULL"),
    }).withColumn("pieces", F.expr(f"CASE WHEN readable AND {needed} THEN regexp_extract_all(raw, {lit(PIECES)}, 0) END"))
    is_key = "get(pieces, n + 1) RLIKE '^\\\\s*:'"
    text = field("try_parse_json(x)", "$", "string")
    df = df.withColumn("fragments", F.expr(
        f"transform(pieces, (x, n) -> CASE WHEN x RLIKE {lit(P_WITH_MORE_IN_JSON)} AND NOT coalesce({is_key}, false) THEN {text} END)"))
    some = F.expr("CASE WHEN exists(fragments, x -> x IS NOT NULL) THEN fragments END")
    df = df.withColumn("cleaned", clean_fragments(some))
    piece = "get(pieces, n)"
    at = "sequence(0, size(pieces) - 1)"
    lost = f"exists({at}, n -> get(cleaned, n).changed AND (get(cleaned, n).broken OR NOT {piece} RLIKE {lit(PAIRED)}))"
    new = f"CASE WHEN get(cleaned, n).changed THEN to_json(CAST(get(cleaned, n).text AS variant)) ELSE {piece} END"
    joined = f"array_join(transform({at}, n -> {new}), '')"
    return df.withColumn("cleaned_json", F.expr(case(
        ("NOT readable", "NULL"), ("cleaned IS NULL", "raw"), (lost, "NULL"), otherwise=joined,
    ))).select(*documents.columns, "rel_path", "cleaned_json")
