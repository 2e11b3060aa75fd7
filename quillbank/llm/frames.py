"""What the operators share: tables, cutting lineage, and narrow Arrow passes over whole texts."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: ASCII letters and digits stay, letters in lower case; any other ASCII character parts words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def words(text: bytes) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a UTF-8 text with A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share.

    It is the one in spark.checkpoint.dir. Where the session names none, a local session gets a temporary
    folder and any other one a folder inside the warehouse, which a cluster shares.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (context.master == "local" or context.master.startswith("local[")):
            named = tempfile.mkdtemp(prefix="quillbank-")
        context.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Writes `df` to the shared checkpoint folder and goes on from there, so that a lost executor costs no more than its task."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


class Shared:
    """A value that every executor gets once. Only values of a bounded size; the caller says which bound."""

    def __init__(self, spark: SparkSession, value: object):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        """The value, unpacked; ask once a task."""
        return cloudpickle.loads(self.packed.value)


def slices(column: pa.Array, step: int = 64) -> Iterator[bytes]:
    """The values of a string column as UTF-8, null as empty, few at a time so that a batch isn't held twice."""
    for at in range(0, len(column), step):
        for value in column.slice(at, step).cast(pa.binary()).to_pylist():
            yield value or b""


def attach(
    df: DataFrame,
    needs: list[str],
    work: Callable[[Iterator[dict[str, pa.Array]]], Iterator[pa.Array]],
    result: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """`df` as columns `row` (a struct of `keep`, all columns by default) and `found` (a struct of the fields in `result`).

    A narrow pass: `work` gets for each Arrow batch the columns `needs` and yields one struct array as long.
    Rows travel packed, so no name of an input column can clash with a name used here.
    """
    keep = df.columns if keep is None else keep
    carried = list(dict.fromkeys([*keep, *needs]))
    packed = df.select(F.struct(*[F.col(quoted(c)).alias(c) for c in carried]).alias("row"))
    row_type = T.StructType([f for c in keep for f in packed.schema["row"].dataType.fields if f.name == c])
    out = T.StructType([T.StructField("row", row_type, False), T.StructField("found", T.StructType.fromDDL(result), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.StructArray] = []

        def inputs():
            for batch in batches:
                row = batch.column(0)
                rows.append(row)
                yield {c: row.field(c) for c in needs}

        for found in work(inputs()):
            row = rows.pop(0)
            kept = pa.StructArray.from_arrays([row.field(c) for c in keep], fields=[row.type.field(c) for c in keep])
            yield pa.RecordBatch.from_arrays([kept, found], names=["row", "found"])

    return packed.mapInArrow(run, out)


def unpacked(df: DataFrame, results: list[str] | None = None) -> DataFrame:
    """The columns of `row` and, of `found`, those in `results` (all by default), which replace columns of the same name."""
    results = df.schema["found"].dataType.names if results is None else results
    kept = [c for c in df.schema["row"].dataType.names if c not in results]
    return df.select(
        *[F.col(f"row.{quoted(c)}").alias(c) for c in kept], *[F.col(f"found.{quoted(c)}").alias(c) for c in results]
    )
