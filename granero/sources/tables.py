"""Scans with declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The source tables and the columns the mart uses.
SOURCE_COLUMNS = {
    "te_producto_cial": ["cod_ramo", "cod_producto", "txt_desc"],
    "te_producto_tec_cial": [
        "cod_ramo_com",
        "cod_producto_cial",
        "cod_ramo",
        "cod_producto_tec",
    ],
    "tiso_producto": ["cod_ramo", "cod_producto", "txt_desc", "cod_suc"],
    "ttarifa_producto": ["cod_tarifa", "cod_ramo", "cod_producto"],
    "ttarifa": ["cod_tarifa", "txt_desc"],
    "te_producto_cial_comis": [
        "cod_agente",
        "cod_tipo_agente",
        "pje_comision",
        "cod_producto",
        "cod_ramo",
    ],
    "magente": ["cod_agente", "cod_tipo_agente", "id_persona"],
    "mpersona": ["id_persona", "nro_nit", "txt_nombre", "txt_apellido1", "txt_apellido2"],
}


def scan(
    spark: SparkSession,
    source: str,
    columns: list[str] | None = None,
    format: str = "parquet",
    schema: str | None = None,
) -> DataFrame:
    """Whole table at a path, or of the catalog with ``format="table"``.

    ``columns`` reaches the file scan, so other columns are not read. A declared
    ``schema`` saves the job that would look it up in the files.
    """
    if format == "table":
        df = spark.table(source)
    else:
        reader = spark.read.format(format)
        df = (reader.schema(schema) if schema else reader).load(source)
    return df.select(*columns) if columns else df


def scan_sources(
    spark: SparkSession, paths: dict[str, str], format: str = "parquet"
) -> dict[str, DataFrame]:
    """Scan source tables, each with just the columns the mart uses.

    ``paths`` maps a table of ``SOURCE_COLUMNS`` to where it is stored, so other
    editions of a table load through the same flows.
    """
    return {
        name: scan(spark, path, SOURCE_COLUMNS[name], format) for name, path in paths.items()
    }
