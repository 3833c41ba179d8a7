"""Copy the written star to an external warehouse through a Spark data source."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from meterstar.sinks.swap import NEXT, recover_table, swap_in
from meterstar.sources.warehouse import Star

# Account suffix, option names and placeholder settings of the connector.
ACCOUNT_SUFFIX = ".snowflakecomputing.com"
REQUIRED = {
    "sfURL": "SNOWFLAKE_ACCOUNT",
    "sfUser": "SNOWFLAKE_USER",
    "sfPassword": "SNOWFLAKE_PASSWORD",
}
FURTHER = {
    "sfDatabase": "SNOWFLAKE_DATABASE",
    "sfSchema": "SNOWFLAKE_SCHEMA",
    "sfWarehouse": "SNOWFLAKE_WAREHOUSE",
}
CONSTANT_OPTIONS = {"JDBC_QUERY_RESULT_FORMAT": "JSON"}
PLACEHOLDERS = {"your_snowflake_account", "your_username", "your_password"}


def snowflake_options(settings: Mapping[str, str]) -> dict[str, str] | None:
    """Connector options from settings such as os.environ.

    None if a credential is absent or still a placeholder: the copy is optional.
    """
    options = {name: settings.get(key) for name, key in REQUIRED.items()}
    if any(not value or value in PLACEHOLDERS for value in options.values()):
        return None
    if not options["sfURL"].endswith(ACCOUNT_SUFFIX):
        options["sfURL"] += ACCOUNT_SUFFIX
    further = {name: settings[key] for name, key in FURTHER.items() if settings.get(key)}
    return options | further | CONSTANT_OPTIONS


def copy_star(
    star: Star,
    options: Mapping[str, str] | None,
    fmt: str = "snowflake",
    target: str = "dbtable",
    switch: Callable[[str, str], None] | None = None,
) -> list[str]:
    """Replace each table of a written star at the target; return the names copied.

    `target` is the option that names the table: `dbtable` for database connectors, `path` for
    file formats, where a `root` option gives the parent folder.

    The copy has two phases. All tables go to side names, `<name>_next`; only when the last one
    is there does each take its own name. So a table that fails leaves the target as it was, and
    the copy can be repeated. At a folder the second phase renames, and a copy that died in it is
    finished by the next one (`sinks.swap`). For a database, `switch(side name, name)` has to put
    the side table in the other's place; without it, the second phase overwrites table by table.
    """
    if options is None:
        return []
    spark, root = star.fact.sparkSession, options.get("root")
    shared = {k: v for k, v in options.items() if k != "root"}
    tables = star.tables()
    places = {name: f"{root.rstrip('/')}/{name}" if root else name for name in tables}

    def write(rows: DataFrame, place: str) -> None:
        rows.write.format(fmt).options(**shared, **{target: place}).mode("overwrite").save()

    def recover() -> None:
        for place in places.values() if root else ():
            recover_table(spark, place)

    recover()
    if root or switch:
        try:
            for name, rows in tables.items():
                write(rows, places[name] + NEXT)
        except BaseException:
            recover()
            raise
    for name, rows in tables.items():
        if root:
            swap_in(spark, places[name])
        elif switch:
            switch(places[name] + NEXT, places[name])
        else:
            write(rows, places[name])
    return list(tables)
