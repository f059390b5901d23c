"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourcast.session import scratch_path, table_path

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# A vocabulary file travels to the executors with the task; larger files are refused.
MAX_VOCABULARY_BYTES = 32 << 20
# Bytes of an Arrow batch that a worker turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) only, so further columns of the input can never clash; null text is empty."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


ARROW_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
               "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
               "array<struct<kind:string,start:int,end:int,disguised:boolean>>": pa.list_(pa.struct(
                   [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("disguised", pa.bool_())]))}


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about SLICE_BYTES, one row at least.  A worker stays alive
    over its tasks and keeps what its largest slice took, beside the executor's heap."""
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def append_columns(df: DataFrame, new: dict[str, str], start: Callable[[], Callable], column: str = "text") -> DataFrame:
    """``df`` with columns computed from the text in ``column``, in slices of Arrow batches.

    ``new`` maps names to types (keys of ARROW_TYPES).  ``start()`` runs once in each task and
    returns a function from a list of texts (null as empty) to one tuple per text.  All columns
    of ``df`` are passed through untouched.
    """
    taken = {c.lower() for c in df.columns} & {c.lower() for c in new}
    if taken:
        raise ValueError(f"the input already has columns {sorted(taken)}")
    added_fields = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in new.items()))
    schema = StructType([*df.schema.fields, *added_fields.fields])
    fields = [pa.field(name, ARROW_TYPES[kind]) for name, kind in new.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in slices(batches):
            rows = list(compute([t or "" for t in batch.column(column).to_pylist()]))
            added = [pa.array(values, f.type) for values, f in zip(zip(*rows, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema=pa.schema([*batch.schema, *fields]))

    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    It cuts the lineage: a lost executor rereads the files instead of redoing the work.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def vocabulary_bytes(path: str) -> bytes:
    """The tokenizer file at ``path`` on the driver, of bounded size."""
    data = Path(path).read_bytes()
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} holds {len(data)} bytes; at most {MAX_VOCABULARY_BYTES} are shipped to the tasks")
    return data


def by_size(rows: Iterable[tuple], size_of, limit: int) -> Iterator[list[tuple]]:
    """Consecutive rows in lists whose sizes add up to about ``limit``; a longer row stands alone."""
    block, total = [], 0
    for row in rows:
        n = size_of(row)
        if block and total + n > limit:
            yield block
            block, total = [], 0
        block.append(row)
        total += n
    if block:
        yield block
