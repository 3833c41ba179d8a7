"""Audits of keys, nulls, type fit and layout, each a plain aggregation.

The warehouse declares PRIMARY KEY, FOREIGN KEY, NOT NULL and column types; Spark
tables enforce none of them, so these operators report what would break them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.operators.star import ROW_BITS
from meterstar.schemas import FACT_PARTITIONS
from meterstar.scratch import staged

# Warehouse type of each Spark type; any other is FALLBACK_TYPE.
WAREHOUSE_TYPES = {
    "long": "NUMBER",
    "integer": "NUMBER",
    "string": "VARCHAR(256)",
    "double": "FLOAT",
    "float": "FLOAT",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}
FALLBACK_TYPE = "VARCHAR(256)"
# Fixed value: the type of money columns that none is declared for.
MONEY_TYPE = "DECIMAL(10,2)"

# The warehouse's declared column types.
DECLARED = {
    "dim_date": {
        "date_key": "INTEGER", "date": "DATE", "day": "SMALLINT", "month": "SMALLINT",
        "quarter": "SMALLINT", "year": "SMALLINT", "month_name": "VARCHAR(10)",
        "day_of_week": "SMALLINT", "is_weekend": "BOOLEAN",
    },
    "dim_geography": {
        "zone_key": "INTEGER", "zone_name": "VARCHAR(100)", "borough": "VARCHAR(50)",
        "service_zone": "VARCHAR(50)",
    },
    "dim_payment": {
        "payment_key": "INTEGER", "payment_type": "VARCHAR(30)", "is_electronic": "BOOLEAN",
    },
    "fact_trips": {
        "trip_id": "BIGINT", "pickup_date_key": "INTEGER", "pickup_zone_key": "INTEGER",
        "dropoff_zone_key": "INTEGER", "payment_key": "INTEGER", "fare_amount": "DECIMAL(10,2)",
        "trip_distance": "DECIMAL(10,2)", "trip_duration": "DECIMAL(12,2)",
        "passenger_count": "SMALLINT", "total_amount": "DECIMAL(10,2)",
        "tip_amount": "DECIMAL(10,2)", "toll_amount": "DECIMAL(10,2)",
        "congestion_surcharge": "DECIMAL(8,2)",
    },
}
# The columns the warehouse declares NOT NULL.
NOT_NULL = {
    "dim_date": ["date_key", "date", "day", "month", "quarter", "year", "month_name",
                 "day_of_week", "is_weekend"],
    "dim_geography": ["zone_key", "zone_name", "borough"],
    "dim_payment": ["payment_key", "payment_type", "is_electronic"],
    "fact_trips": ["trip_id", "pickup_date_key", "pickup_zone_key", "dropoff_zone_key",
                   "payment_key"],
}


# Known keys that an audit holds as bits: 128 KB of them.
KNOWN_SPAN = 1 << 20
BUCKET_BYTES = 4096  # of Spark's bitmaps


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary-key values that occur more than once, with their row count.

    Rows are counted on the map side first, so a hot key shuffles one row per task.
    """
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def primary_key_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: the number of duplicated key values."""
    audits = [
        duplicate_keys(rows, key)
        .agg(F.count(F.lit(1)).alias("duplicate_keys"))
        .select(F.lit(name).alias("table_name"), "duplicate_keys")
        for name, (rows, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, audits)


def id_runs(fact: DataFrame) -> DataFrame:
    """Per file of a written fact and block of ids: block, file, low, high, `rows`, `steady`.

    A block is what one writing task gave out. `steady` says that the ids go up by one from row
    to row of the file, so that they differ, and are all of low to high. One narrow pass that
    shuffles a row for each file and block.
    """
    row = F.col("trip_id") - F.col("_metadata.row_index")
    block = F.shiftright("trip_id", ROW_BITS).alias("block")
    return fact.groupBy(block, F.col("_metadata.file_path").alias("file")).agg(
        F.min("trip_id").alias("low"),
        F.max("trip_id").alias("high"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.min(row) == F.max(row), F.lit(False)).alias("steady"),
    )


def doubtful_blocks(runs: DataFrame) -> DataFrame:
    """The blocks whose ids `runs` does not prove to differ: a file's ids are not steady, or
    the intervals of two files overlap. Blocks never share an id with each other.

    The sweep goes over the files of a block, in the order of their lowest ids.
    """
    before = Window.partitionBy("block").orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)
    overlaps = F.coalesce(F.col("low") <= F.max("high").over(before), F.lit(False))
    doubtful = runs.withColumn("overlaps", overlaps).filter(
        F.col("overlaps") | ~F.col("steady") | F.col("block").isNull()
    )
    return doubtful.select("block").distinct()


def duplicate_ids(fact: DataFrame) -> DataFrame:
    """`duplicate_keys` of a written fact's trip ids, from intervals of ids.

    Only the blocks that intervals cannot clear are counted id by id; in a fact whose files are
    as their tasks wrote them there are none, and no id is shuffled. A month that was rewritten
    with older trips in it is counted.
    """
    doubtful = staged(doubtful_blocks(id_runs(fact)), "doubtful-blocks")
    ids = fact.select("trip_id")
    if doubtful.isEmpty():
        return duplicate_keys(ids.limit(0), ["trip_id"])
    own = F.shiftright("trip_id", ROW_BITS).eqNullSafe(F.col("block"))
    return duplicate_keys(ids.join(doubtful, own, "left_semi"), ["trip_id"])


def orphan_keys(rows: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a dimension row, with their row count.

    The fact is reduced to its distinct keys before it meets the dimension. A null
    key has no dimension row, so it counts as an orphan.
    """
    used = rows.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    known = dim.select(F.col(key).alias("known"))
    return used.join(known, F.col("key") == F.col("known"), "left_anti")


def foreign_key_audit(
    fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """One row per foreign key: orphan key values, the fact rows that hold them, and the
    rows whose key is null (no orphans: a null refers to nothing).

    `references` maps a fact column to its dimension and that dimension's key. All
    columns are counted in one scan of the fact, by grouping sets.
    """
    columns = list(references)
    used = (
        fact.groupingSets([[c] for c in columns], *columns)
        .agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("rows"))
    )
    # In the grouping id, the bit of the one column that is kept is 0.
    full = (1 << len(columns)) - 1
    kept = {
        column: F.col("gid") == full - (1 << (len(columns) - 1 - position))
        for position, column in enumerate(columns)
    }
    used = used.select(
        F.coalesce(*[F.when(kept[c], c) for c in columns]).alias("foreign_key"),
        F.coalesce(*[F.when(kept[c], F.col(c).cast("string")) for c in columns]).alias("used"),
        "rows",
    )

    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit(c).alias("known_in"), F.col(key).cast("string").alias("known"))
            for c, (dim, key) in references.items()
        ],
    ).distinct()
    null = F.col("used").isNull()
    orphan = F.col("known").isNull() & ~null

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))

    counted = (
        used.join(
            known,
            (F.col("foreign_key") == F.col("known_in")) & (F.col("used") == F.col("known")),
            "left",
        )
        .groupBy("foreign_key")
        .agg(
            F.count_if(orphan).alias("orphan_keys"),
            rows_where(orphan).alias("orphan_rows"),
            rows_where(null).alias("null_rows"),
        )
    )
    # From the list of keys, so that an empty fact gives a row of zeros for each.
    listed = fact.sparkSession.createDataFrame([(c,) for c in columns], "foreign_key string")
    return listed.join(counted, "foreign_key", "left").fillna(0)


def _whole(rows: DataFrame, column: str) -> Column | None:
    """A key column as a long; None if its type is neither whole numbers nor dates."""
    kind = rows.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(column).cast("bigint")
    return None


def _known_bits(dim: DataFrame, key: str) -> tuple[int, Column] | None:
    """The least key of a dimension, and its keys as bits of an array of longs, from that one on.

    None if the keys lie too far apart, or are no whole numbers. The bits are put together by
    Spark's bitmap aggregate, 32,768 to a row, and come to the driver as KNOWN_SPAN bits at most.
    """
    value = _whole(dim, key)
    if value is None:
        return None
    least, most = dim.agg(F.min(value), F.max(value)).first()
    if least is None:
        return 0, F.array().cast("array<bigint>")
    if most - least >= KNOWN_SPAN:
        return None
    at = value - least + 1  # bitmap functions count from 1
    buckets = (
        dim.filter(value.isNotNull()).groupBy(F.bitmap_bucket_number(at).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    )
    held = bytearray(max(r.bucket for r in buckets) * BUCKET_BYTES)
    for r in buckets:
        held[(r.bucket - 1) * BUCKET_BYTES : r.bucket * BUCKET_BYTES] = r.bits
    words = [int.from_bytes(held[i : i + 8], "little", signed=True) for i in range(0, len(held), 8)]
    while words and not words[-1]:
        words.pop()
    # One literal, whatever its length; the optimizer folds it.
    return least, F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def _unknown(rows: DataFrame, column: str, known: tuple[int, Column]) -> Column:
    """Whether a key that is not null is none of the known ones."""
    least, words = known
    value = _whole(rows, column)
    # Compared before it is subtracted: no key is out of range.
    at = F.when(value.between(least, least + KNOWN_SPAN - 1), value - least)
    word = F.get(words, F.floor(at / 64).cast("int"))
    bit = F.getbit(word, (at % 64).cast("int"))
    return value.isNotNull() & (F.coalesce(bit, F.lit(0)) == 0)


def foreign_key_audit_by_bits(
    fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """`foreign_key_audit` by bitmaps of the known keys: one pass that counts within its tasks.

    Rows are not expanded per key, and a task hands over one row. Only if there are orphans are
    the rows that hold some counted key by key. Keys that are no whole numbers or dates, or that
    lie KNOWN_SPAN or more apart, are left to `foreign_key_audit`.
    """
    known = {c: _known_bits(dim, key) for c, (dim, key) in references.items()}
    if any(k is None for k in known.values()) or any(_whole(fact, c) is None for c in references):
        return foreign_key_audit(fact, references)
    unknown = {c: _unknown(fact, c, k) for c, k in known.items()}
    counted = fact.agg(
        *[F.count_if(unknown[c]).alias(f"orphans {c}") for c in references],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls {c}") for c in references],
    ).first()
    found: dict[str, tuple[int, int]] = {}
    if any(counted[f"orphans {c}"] for c in references):
        some = fact.filter(reduce(lambda a, b: a | b, unknown.values()))
        some = some.select(*[F.when(unknown[c], F.col(c)).alias(c) for c in references])
        found = {r.foreign_key: (r.orphan_keys, r.orphan_rows)
                 for r in foreign_key_audit(some, references).collect()}
    return fact.sparkSession.createDataFrame(
        [(c, *found.get(c, (0, 0)), counted[f"nulls {c}"]) for c in references],
        "foreign_key string, orphan_keys bigint, orphan_rows bigint, null_rows bigint",
    )


def null_audit(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: how many nulls it holds, all counted in one pass."""
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "nulls"
    )


def _integer_range(bits: int) -> tuple[int, int]:
    return -(2 ** (bits - 1)), 2 ** (bits - 1) - 1


# Whole numbers a declared integer type holds.
RANGES = {"SMALLINT": _integer_range(16), "INTEGER": _integer_range(32), "BIGINT": _integer_range(64)}


def _declared_type(field: T.StructField) -> str:
    """The warehouse type of a column that none is declared for."""
    if isinstance(field.dataType, T.DecimalType):
        return MONEY_TYPE
    return WAREHOUSE_TYPES.get(field.dataType.typeName(), FALLBACK_TYPE)


def _fit(field: T.StructField, declared: str | None = None) -> dict:
    """Warehouse type of a column and the aggregates that measure and test it.

    A declared DECIMAL(p,s) is tested for digits before the point and after it; one that
    nobody declared is measured against MONEY_TYPE's size alone. NaN and infinity fit no
    exact type, and neither does a value that no decimal(38,10) holds.
    """
    column = F.col(field.name)
    no_length, no_size = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    kind = declared or _declared_type(field)
    numeric = isinstance(field.dataType, T.NumericType)
    size = F.max(F.abs(column)).cast("double") if numeric else no_size
    base, _, sizes = kind.rstrip(")").partition("(")
    if base == "DECIMAL":
        digits, places = map(int, sizes.split(","))
        exact = column.try_cast("decimal(38,10)")
        bad = F.abs(exact) >= F.lit(10 ** (digits - places)).cast("decimal(28,0)")
        if declared:
            bad = bad | (exact != F.round(exact, places))
        lost = column.isNotNull() & exact.isNull()
        length, fits = no_length, F.count_if(lost | bad) == 0
    elif base == "VARCHAR":
        length = F.max(F.length(column.cast("string"))).cast("bigint")
        fits = F.coalesce(length <= int(sizes), F.lit(True))
        size = no_size
    elif base in RANGES and numeric:
        value, (least, most) = column, RANGES[base]
        if isinstance(field.dataType, T.FractionalType):
            # NaN and infinity have no decimal; nor does what is far out of any range.
            value = column.try_cast("decimal(38,10)")
        whole = value.between(F.lit(least), F.lit(most)) & (value == F.floor(value))
        length, fits = no_length, F.count_if(column.isNotNull() & ~F.coalesce(whole, F.lit(False))) == 0
    else:
        expected = {"DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}
        same = not declared or expected.get(base) == field.dataType.typeName()
        length, fits = no_length, F.lit(same)
        size = no_size if not declared else size
    return dict(type=kind, length=length, size=size, fits=fits)


def type_fit_audit(rows: DataFrame, declared: Mapping[str, str] | None = None) -> DataFrame:
    """One row per column: its warehouse type and whether every value fits it.

    `declared` gives columns their types; the others are measured by a general rule, text
    against VARCHAR(256), money against the size of DECIMAL(10,2), the rest always fits.
    All columns are measured in one pass.
    """
    declared = declared or {}
    fits = {field.name: _fit(field, declared.get(field.name)) for field in rows.schema.fields}
    measured = rows.agg(
        *[
            fit[part].alias(f"{part}_{i}")
            for i, fit in enumerate(fits.values())
            for part in ("length", "size", "fits")
        ]
    )
    report = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(fit["type"]).alias("warehouse_type"),
            F.col(f"length_{i}").alias("max_length"),
            F.col(f"size_{i}").alias("max_abs"),
            F.col(f"fits_{i}").alias("fits"),
        )
        for i, (name, fit) in enumerate(fits.items())
    ]
    return measured.select(F.inline(F.array(*report)))


def by_table(audits: Mapping[str, DataFrame]) -> DataFrame:
    """The audits of several tables as one, led by `table_name`."""
    named = [a.select(F.lit(name).alias("table_name"), "*") for name, a in audits.items()]
    return reduce(DataFrame.unionByName, named)


def partition_layout(fact: DataFrame) -> DataFrame:
    """Rows and files per fact partition of a fact read from files."""
    per_file = fact.groupBy(*FACT_PARTITIONS, F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return per_file.groupBy(*FACT_PARTITIONS).agg(
        F.sum("rows").alias("trips"), F.count(F.lit(1)).alias("files")
    )
