"""Reading the product table back from a database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column of the stored table -> column and type of a read-back row.
PRODUCT_READ_BACK = [
    ("RamoPlanId", "RamoPlanID", "int"),
    ("PlanTecnicoID", "PlanTecnicoID", "int"),
    ("PlanTecnico", "PlanTecnico", "string"),
    ("TipoProductoId", "TipoProductoId", "int"),
    ("CategoriaId", "CategoriaId", "int"),
    ("RamoComercialID", "RamoComercialID", "int"),
    ("ProductoComercialID", "ProductoComercialID", "int"),
    ("ProductoComercial", "ProductoComercial", "string"),
    ("SucursalRamoComercialID", "SucursalRamoComercialID", "int"),
    ("EstadoHabilitado", "EstadoHabilitado", "int"),
    ("ProductoId", "ProductoId", "int"),
    ("ProductoTecnicoId", "ProductoTecnicoId", "int"),
    ("Moneda", "Moneda", "string"),
]


def _int32(column: Column) -> Column:
    """The whole number as an int; one out of range fails, with ANSI mode on or off."""
    wide = column.cast("bigint")
    fits = wide.between(-(2**31), 2**31 - 1)
    wrong = F.raise_error(F.concat(F.lit("not a 32-bit number: "), wide.cast("string")))
    return F.when(wide.isNull(), F.lit(0)).when(fits, wide.cast("int")).otherwise(wrong.cast("int"))


def read_back(stored: DataFrame) -> DataFrame:
    """Rows of the stored product table: a missing int is 0, a missing text stays."""
    return stored.select(
        *(
            (
                _int32(F.col(source))
                if kind == "int"
                else F.col(source).cast(kind)
            ).alias(name)
            for source, name, kind in PRODUCT_READ_BACK
        )
    )


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a database table over several connections.

    The table is cut on the numeric ``column`` between its least and greatest
    value, which the database is asked for first. Filters and column selection
    on the result reach the database.
    """
    options = {"url": url, **(properties or {})}
    bounds = (
        spark.read.format("jdbc")
        .options(**options)
        .option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}")
        .load()
        .first()
    )
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if bounds is not None and bounds[0] is not None:
        reader = reader.options(
            partitionColumn=column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1] + 1),
            numPartitions=str(partitions),
        )
    return reader.load()


def plain_scan(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None
) -> DataFrame:
    """Read a database table over one connection."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {})).load()


def cuts_query(table: str, column: str, partitions: int) -> str:
    """The least value of each of ``partitions`` shares with equally many rows.

    The database ranks the column's values, from its index if there is one, and sends
    one number per share.
    """
    ranked = (
        f"SELECT {column} AS c, NTILE({partitions}) OVER (ORDER BY {column}) AS share "
        f"FROM {table} WHERE {column} IS NOT NULL"
    )
    return f"SELECT MIN(c) AS cut FROM ({ranked}) ranked GROUP BY share"


def share_predicates(column: str, cuts: list[int]) -> list[str]:
    """Conditions that every row meets exactly one of; rows without a value are in the first."""
    borders = sorted(set(cuts))[1:]
    if not borders:
        return ["1 = 1"]
    return [
        f"{column} < {borders[0]} OR {column} IS NULL",
        *(f"{column} >= {low} AND {column} < {high}" for low, high in zip(borders, borders[1:])),
        f"{column} >= {borders[-1]}",
    ]


def balanced_scan(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a database table over several connections with equally many rows each.

    Unlike ``jdbc_scan``, gaps in the numeric ``column`` do not matter: it is cut
    where its values lie. Only rows that share one value stay together. The table must
    not change between the two reads, or shares become uneven; no row is lost by that.
    Filters and column selection on the result reach the database.
    """
    options = {"url": url, **(properties or {})}
    found = (
        spark.read.format("jdbc")
        .options(**options)
        .option("query", cuts_query(table, column, partitions))
        .load()
        .collect()
    )
    return spark.read.jdbc(
        url, table, predicates=share_predicates(column, [row[0] for row in found]), properties=properties or {}
    )
