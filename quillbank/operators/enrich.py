"""Enrichment of documents from a reference table, first match per id.

The join key of a document is its mapped id as text.  Documents without one
join on their path under a flag no table row has, so they spread over the tasks.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbank import fixed_values as fv
from quillbank.functions.sql import case, lit
from quillbank.functions.variants import field, is_array, is_none, is_object, kind, shown, string_of
from quillbank.sources.documents import REFERENCE_COLUMNS, configure, parsed

KEY, *VALUES = REFERENCE_COLUMNS
#: Bits that a sketch of the table's ids has, dealt to rows of 4 kB: 8 MB in all, however many ids there are.
SKETCH_BITS = 1 << 26
ENRICHED, NO_ID, NO_MATCH, UNREADABLE = "enriched", "no_id", "no_match", "unreadable"

# New root keys in the order they are added, each with the column or constant it takes.
OVERWRITTEN = {
    "answer": lit(""),
    "section_id": "section_id",
    "language": "language",
    "subject_id": lit(fv.ENRICHED_ID),
    "subject": "subject",
    "grade_id": lit(fv.ENRICHED_ID),
    "grade": "grade",
    "country": "country",
    "question_id": "mapped_id",
}


def first_matches(reference: DataFrame, order: str = "file_order") -> DataFrame:
    """The first row of every id in table order.

    An aggregate, not a ranking window: rows of a frequent id are reduced before
    the shuffle, so no task sees all of them.
    """
    row = F.struct(*[F.col(c) for c in VALUES])
    return (
        reference.where(F.col(KEY).isNotNull())
        .groupBy(F.col(KEY).alias("mapped_id"))
        .agg(F.min_by(row, F.col(order)).alias("match"))
    )


def category(parts: str) -> str:
    """``multipart``, the sole part's type, or ``unknown``; NULL where the parts cannot be read."""
    kind_of = field(parts, "$[0].type")
    return case(
        (f"{parts} IS NULL", lit("unknown")),
        (f"NOT {is_array(parts)}", "NULL"),
        (f"{field(parts, '$[1]')} IS NOT NULL", lit("multipart")),
        (f"{field(parts, '$[0]')} IS NULL", lit("unknown")),
        (f"NOT {is_object(field(parts, '$[0]'))}", "NULL"),
        (f"{kind_of} IS NULL", lit("unknown")),
        otherwise=string_of(kind_of),
    )


def enriched_text() -> str:
    """The document with its root keys overwritten, as JSON text in the original key order.

    Nested values keep their own text; scalar roots are written from VARIANT.
    """
    names = ", ".join(lit(k) for k in OVERWRITTEN)
    new = case(*[(f"k = {lit(k)}", f"coalesce(to_json(CAST({v} AS variant)), 'null')")
                 for k, v in OVERWRITTEN.items()])
    old = case((f"{kind('try_element_at(leaves, k)')} RLIKE '^(ARRAY|OBJECT)'", "try_element_at(nested, k)"),
               otherwise="to_json(try_element_at(leaves, k))")
    value = f"CASE WHEN k IN ({names}) THEN {new} ELSE {old} END"
    keys = f"array_distinct(concat(json_object_keys(raw), array({names})))"
    pairs = f"transform({keys}, k -> concat(to_json(CAST(k AS variant)), ':', {value}))"
    return f"concat('{{', array_join({pairs}, ','), '}}')"


def with_category(documents: DataFrame) -> DataFrame:
    """Adds ``category``, ``mapped_id`` and ``readable`` to a bank with ``raw``."""
    df = documents.withColumn("doc", F.expr(parsed("raw")))
    metadata, mapped = field("doc", "$.metadata"), field("doc", "$.metadata.mapped_id")
    return df.withColumns({
        "category": F.expr(case((is_object("doc"), category(field("doc", "$.parts"))))),
        "mapped_id": F.expr(f"CASE WHEN NOT {is_none(mapped)} THEN {shown(mapped)} END"),
        "readable": F.expr(
            f"{is_object('doc')} AND ({metadata} IS NULL OR {is_object(metadata)})"),
    }).withColumn("readable", F.expr("readable AND category IS NOT NULL"))


def _slot(key: str) -> str:
    return f"pmod(xxhash64({key}), {SKETCH_BITS}L) + 1"


def id_sketch(first: DataFrame) -> DataFrame:
    """(slot_row, bits): one bit for the hash of every id of ``first`` (join_key); at most ``SKETCH_BITS`` / 32768 rows."""
    slots = first.selectExpr(f"{_slot('join_key')} AS slot")
    return slots.groupBy(F.expr("bitmap_bucket_number(slot)").alias("slot_row")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))


def with_chance(documents: DataFrame, sketch: DataFrame) -> DataFrame:
    """Adds ``chance``: false only where the id of a document (has_id, join_key) is surely not among those of the sketch.

    The sketch is broadcast, which its fixed size bounds, so documents stay where they are.
    """
    position = f"bitmap_bit_position({_slot('join_key')})"
    byte = f"conv(hex(substring(bits, CAST({position} DIV 8 AS int) + 1, 1)), 16, 10)"
    bit = f"shiftright(CAST({byte} AS int), CAST({position} % 8 AS int)) & 1"
    placed = documents.withColumn("slot_row", F.expr(f"CASE WHEN has_id THEN bitmap_bucket_number({_slot('join_key')}) END"))
    joined = placed.join(F.broadcast(sketch), "slot_row", "left")
    return joined.withColumn("chance", F.expr(f"bits IS NOT NULL AND {bit} = 1")).drop("slot_row", "bits")


def enrich(documents: DataFrame, reference: DataFrame, order: str = "file_order", few_matches: bool = False) -> DataFrame:
    """Documents with nine root keys taken from their first match.

    Adds ``category``, ``mapped_id``, ``status`` and ``enriched_json``.  Without an
    id or a match the text stays as it is; an unreadable document has none.
    Only the text goes through the join; what is found is parsed behind it.
    With ``few_matches`` a sketch of the table's ids keeps documents without a match out of the join and its shuffle, at
    the price of a second scan: worth it where the table is too large to be broadcast and most documents have no match.
    """
    configure(documents.sparkSession)
    docs = with_category(documents).withColumns({
        "has_id": F.col("mapped_id").isNotNull(),
        "join_key": F.coalesce("mapped_id", "path"),
    }).drop("doc")
    first = first_matches(reference, order).select(
        F.lit(True).alias("has_id"), F.col("mapped_id").alias("join_key"), "match")
    if few_matches:
        docs = with_chance(docs, id_sketch(first))
        apart = docs.where("NOT chance").withColumn("match", F.lit(None).cast(first.schema["match"].dataType)).drop("chance")
        joined = docs.where("chance").drop("chance").join(first, ["has_id", "join_key"], "left").unionByName(apart)
    else:
        joined = docs.join(first, ["has_id", "join_key"], "left")
    status = case(
        ("NOT readable", lit(UNREADABLE)),
        ("mapped_id IS NULL", lit(NO_ID)),
        ("match IS NULL", lit(NO_MATCH)),
        otherwise=lit(ENRICHED),
    )
    out = joined.withColumn("status", F.expr(status)).select(
        *documents.columns, "category", "mapped_id", "status",
        *[F.col("match")[c].alias(c) for c in VALUES])
    enriched = F.expr(f"status = {lit(ENRICHED)}")
    out = out.withColumns({
        "leaves": F.when(enriched, F.expr(field(parsed("raw"), "$", "map<string,variant>"))),
        "nested": F.when(enriched, F.from_json("raw", "map<string,string>")),
    })
    text = case((f"status = {lit(ENRICHED)}", enriched_text()), (f"status = {lit(UNREADABLE)}", "NULL"),
                otherwise="raw")
    return out.withColumn("enriched_json", F.expr(text)).drop("leaves", "nested")
