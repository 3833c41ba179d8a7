"""What several operators share: reading a text column in bounded pieces."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterstar.scratch import staged

SLICE_BYTES = 2 << 20
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
SLICE_ROWS = 2000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice has `limit` bytes in the string column `text`, or one row.

    An Arrow batch holds a fixed number of rows; with very long texts its lists and
    arrays in Python would be many times larger than those of a usual batch.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start, size = 0, 0
        for i, length in enumerate(pc.binary_length(column).to_pylist()):
            if i > start and (size + (length or 0) > limit or i - start >= SLICE_ROWS):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length or 0
        if start < batch.num_rows:
            yield batch.slice(start)


# Byte tables that make every separator of words a space and A-Z lower case.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BY_WHITESPACE = bytes(32 if 9 <= b <= 13 else b for b in _LOWER)
BY_SYMBOLS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in _LOWER)
PIECE_BYTES = 1 << 20


def words_of(text: str | None, table: bytes, limit: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lists of about `limit` bytes; a null text has none.

    `table` is BY_WHITESPACE or BY_SYMBOLS. A list of all words of a very long text would be
    many times larger than the text.
    """
    data = (text or "").encode("utf-8", "surrogatepass").translate(table)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + limit) if len(data) - start > limit else -1
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from wherever the driver did.

    Executors elsewhere get it by --py-files or an installed package.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def in_tasks(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """mapInArrow with the package importable and Arrow batches of bounded size.

    Spark's default of 64 MB a batch is held several times over, in the JVM and in Python; a
    smaller setting of the session's own is left alone.
    """
    spark = df.sparkSession
    importable(spark)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if size(spark.conf.get(BATCH_SETTING)) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        # Workers outlive tasks: what Arrow holds back goes to the system.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def over_texts(
    df: DataFrame,
    text: str,
    schema: str,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, object]]],
    keep: bool = False,
) -> DataFrame:
    """Apply a function of slices in the tasks.

    `make` is called once per task and gives the function; that returns the columns of
    `schema` by name, or an empty dict for no rows. With `keep`, it returns one value per
    row and the rows keep their own columns.
    """
    new = StructType.fromDDL(schema)
    names = new.fieldNames()
    own = df.schema.fieldNames() if keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for piece in slices(batches, text):
            out = function(piece)
            if out:
                made = [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n]) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.columns if keep else []), *made], names=[*own, *names]
                )

    return in_tasks(df, run, StructType([*(df.schema.fields if keep else []), *new.fields]))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it while the rows have a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def labelled_sample(docs: DataFrame, labelled: DataFrame, texts: int, by_label: bool = False,
                    most_bytes: int | None = None) -> DataFrame:
    """id, label, text: at most about `texts` labelled texts, or so many of either label.

    `docs` has id and text, `labelled` id and label. Equal rows are one, and rows are chosen by
    a hash of id and text, so that the bound holds however often an id or a row repeats. Texts
    over `most_bytes` are not chosen.
    """
    mark = F.xxhash64("text").alias("mark")
    rows = docs if most_bytes is None else docs.filter(F.octet_length("text") <= most_bytes)
    rows = rows.filter("text is not null")
    pairs = staged(rows.select("id", mark).join(labelled, "id").select("id", "mark", "label").distinct(),
                   "labelled-pairs")
    steps, group = 1 << 20, F.col("label") if by_label else F.lit(None)
    sizes = {r[0]: r[1] for r in pairs.groupBy(group.alias("group")).agg(F.count(F.lit(1))).collect()}
    if not sizes:
        return rows.join(labelled, "id").select("id", "label", "text").limit(0)
    place = F.pmod(F.xxhash64("id", "mark"), F.lit(steps))
    limit = [F.lit(int(steps * min(1.0, texts / n))) for n in sizes.values()]
    chosen = [(F.col("label") == k if by_label else F.lit(True)) & (place < at) for k, at in zip(sizes, limit)]
    # Bounded by `texts`, so this side is small whatever the number of labels.
    some = F.broadcast(pairs.filter(reduce(lambda a, b: a | b, chosen)))
    return rows.select("id", "text", mark).join(some, ["id", "mark"]).groupBy("id", "mark", "label").agg(
        F.min("text").alias("text")
    ).select("id", "label", "text")
