"""Partitioned tables and files that can be written again without harm."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column types a sink table may have.
COLUMN_TYPES = {
    T.IntegerType(): "int",
    T.LongType(): "bigint",
    T.StringType(): "string",
    T.BooleanType(): "boolean",
    T.DoubleType(): "double",
}

# Bytes of columns that a file is made of at most: each file is written by one task, which reads all of it.
MAX_FILE_BYTES = 512 << 20


def _files(df: DataFrame, files: int) -> int:
    """As many files as asked for, or as the rows' size needs."""
    wide = [name for name, kind in df.dtypes if kind == "string"]
    sizes = [F.coalesce(F.octet_length(_quoted_column(name)), F.lit(0)).cast("long") for name in wide]
    row = reduce(add, sizes, F.lit(8 * (len(df.columns) - len(wide))).cast("long"))
    size = df.agg(F.coalesce(F.sum(row), F.lit(0).cast("long"))).first()[0]
    return max(files, -(-size // MAX_FILE_BYTES))


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _quoted_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_ddl(schema: T.StructType) -> str:
    """Column list of the sink table; any type outside the five is an error."""
    columns = []
    for field in schema.fields:
        if field.dataType not in COLUMN_TYPES:
            raise TypeError(f"column {field.name} has type {field.dataType.simpleString()}, which no sink takes")
        columns.append(f"{_quoted_column(field.name)} {COLUMN_TYPES[field.dataType]}")
    return ", ".join(columns)


def partition_literal(value: int | str, partition_type: str) -> str:
    if partition_type == "bigint":
        return str(int(value))
    if partition_type == "string":
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"partition type {partition_type} is neither bigint nor string")


def write_partition(
    df: DataFrame,
    table: str,
    partition: Mapping[str, tuple[int | str, str]],
    location: str | None = None,
    files: int | None = None,
) -> None:
    """Create the table if it is missing and replace exactly one partition of it.

    ``partition`` maps each partition column to its value and type. Rows, none included, are written to a new folder
    below the table's ``_versions``; when they are all there, the catalog is told that the partition lies there. So
    the table's readers see the old rows or the new ones, never a part, and a run that fails changes nothing. Folders of
    earlier versions stay for readers that began before, until someone cleans them.
    ``files`` is how many there are, or more where one would hold more than :data:`MAX_FILE_BYTES`.
    Columns go by name, and have to be the table's by name and type: nothing is left out or changed on the way.
    """
    spark = df.sparkSession
    keys = ", ".join(f"{_quoted_column(name)} {kind}" for name, (_, kind) in partition.items())
    place = f" LOCATION {partition_literal(location, 'string')}" if location else ""
    values = ", ".join(
        f"{_quoted_column(name)} = {partition_literal(value, kind)}" for name, (value, kind) in partition.items()
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({column_ddl(df.schema)}, {keys}) "
        f"USING PARQUET PARTITIONED BY ({', '.join(map(_quoted_column, partition))}){place}"
    )
    held = {field.name: field.dataType for field in spark.table(_quoted(table)).schema if field.name not in partition}
    given = {field.name: field.dataType for field in df.schema}
    if len(df.columns) != len(given) or given != held:
        odd = sorted(name for name in held.keys() | given.keys() if held.get(name) != given.get(name))
        raise ValueError(f"columns of the rows and of {table} differ in name or type: {', '.join(odd) or 'a name twice'}")
    ordered = df.select(*map(_quoted_column, held))
    if files is not None:
        # Not coalesce, which would also run everything before it in that few tasks.
        ordered = ordered.repartition(_files(ordered, files))
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'")
    folder = f"{described.first()['data_type']}/_versions/{uuid.uuid4().hex}"
    ordered.write.parquet(folder)
    place = f"LOCATION {partition_literal(folder, 'string')}"
    # Either is one step of the catalog, and all that readers notice.
    shown = spark.sql(f"SHOW PARTITIONS {_quoted(table)} PARTITION ({values})")
    if shown.isEmpty():
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS PARTITION ({values}) {place}")
    else:
        spark.sql(f"ALTER TABLE {_quoted(table)} PARTITION ({values}) SET {place}")


def save_by_date(
    df: DataFrame,
    table: str,
    dt: int | str,
    partition_type: str = "bigint",
    location: str | None = None,
    files: int | None = None,
) -> None:
    """Replace the ``stat_date = dt`` partition of a table."""
    write_partition(df, table, {"stat_date": (dt, partition_type)}, location, files)


def save_by_hour(
    df: DataFrame, table: str, stat_date: int, stat_hour: int, location: str | None = None, files: int | None = None
) -> None:
    """Replace one (date, hour) partition of a table."""
    write_partition(
        df, table, {"stat_date": (stat_date, "bigint"), "stat_hour": (stat_hour, "bigint")}, location, files
    )


def save_lines(df: DataFrame, folder: str) -> None:
    """Tab separated text files: all columns in order, as they are, a NULL as nothing."""
    columns = [F.coalesce(F.col(_quoted_column(name)).cast("string"), F.lit("")) for name in df.columns]
    df.select(F.concat_ws("\t", *columns).alias("value")).write.mode("overwrite").text(folder)
