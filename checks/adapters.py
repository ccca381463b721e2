"""The mart's source tables, made from the supplied ones.

A source table is one supplied table with expressions over all of its rows. The
expressions are SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from granero.sources.tables import scan


# Columns used of the supplied tables.
SUPPLIED = {
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE",
    "customer": "c_custkey BIGINT",
}


def text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def decimal_text(expression: str) -> str:
    return f"CAST(CAST({expression} AS DOUBLE) AS STRING)"


def null_when(condition: str, expression: str) -> str:
    return f"CASE WHEN {condition} THEN NULL ELSE {expression} END"


@dataclass(frozen=True)
class Adapter:
    table: str
    columns: dict[str, str]

    def sql(self) -> str:
        columns = ", ".join(f"{value} AS {name}" for name, value in self.columns.items())
        return f"SELECT {columns} FROM {self.table}"

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{sf_dir}/{self.table}.parquet"
        supplied = scan(spark, path, schema=SUPPLIED[self.table])
        return supplied.selectExpr(*(f"{value} AS {name}" for name, value in self.columns.items()))


ADAPTERS = {
    "te_producto_cial": Adapter(
        "part",
        {
            "cod_ramo": null_when("p_partkey % 97 = 0", text("p_partkey % 10")),
            "cod_producto": text("p_partkey"),
            "txt_desc": null_when("p_partkey % 31 = 0", "p_name"),
        },
    ),
    "te_producto_tec_cial": Adapter(
        "lineitem",
        {
            "cod_ramo_com": null_when("l_partkey % 97 = 0", text("l_partkey % 10")),
            "cod_producto_cial": text("l_partkey"),
            "cod_ramo": text("l_suppkey % 7"),
            "cod_producto_tec": decimal_text("l_suppkey"),
        },
    ),
    "tiso_producto": Adapter(
        "supplier",
        {
            "cod_ramo": text("s_suppkey % 7"),
            "cod_producto": text("s_suppkey"),
            "txt_desc": null_when("s_suppkey % 5 = 0", "s_name"),
            "cod_suc": text("s_nationkey"),
        },
    ),
    "ttarifa_producto": Adapter(
        "lineitem",
        {
            "cod_tarifa": null_when("l_orderkey % 50 = 0", text("l_partkey % 500")),
            "cod_ramo": decimal_text("l_suppkey % 7"),
            "cod_producto": text("l_suppkey"),
        },
    ),
    "ttarifa": Adapter(
        "part",
        {
            "cod_tarifa": text("p_partkey % 500"),
            "txt_desc": null_when("p_partkey % 11 = 0", "p_type"),
        },
    ),
    "te_producto_cial_comis": Adapter(
        "orders",
        {
            "cod_agente": text("o_custkey"),
            "cod_tipo_agente": text("o_custkey % 3"),
            "pje_comision": text("CAST(ROUND(o_totalprice * 100) AS BIGINT)"),
            "cod_producto": decimal_text("o_orderkey % 200"),
            "cod_ramo": text("o_orderkey % 10"),
        },
    ),
    "magente": Adapter(
        "customer",
        {
            "cod_agente": text("c_custkey"),
            "cod_tipo_agente": text("c_custkey % 3"),
            "id_persona": null_when("c_custkey % 13 = 0", text("c_custkey % 10")),
        },
    ),
    "mpersona": Adapter(
        "supplier",
        {
            "id_persona": null_when("s_suppkey = 9", text("s_suppkey")),
            "nro_nit": (
                "CASE s_suppkey % 4"
                f" WHEN 0 THEN CONCAT({text('10000000 + s_suppkey')}, 'k')"
                f" WHEN 1 THEN CONCAT({text('10000000 + s_suppkey')}, '5')"
                " WHEN 2 THEN NULL"
                f" ELSE CONCAT('1.000.', {text('s_suppkey')}, '-9') END"
            ),
            "txt_nombre": "CONCAT('  ', s_name, ' ')",
            "txt_apellido1": null_when("s_suppkey % 3 = 0", "'perez'"),
            "txt_apellido2": null_when("s_suppkey % 2 = 0", "'soto '"),
        },
    ),
}

# A second edition of the product sources, under names of its own.
OTHER_EDITION = {
    "te_producto_cial": Adapter(
        "part",
        {
            "cod_ramo": null_when("p_partkey % 89 = 0", text("p_partkey % 4")),
            "cod_producto": text("p_partkey"),
            "txt_desc": null_when("p_partkey % 29 = 0", "p_type"),
        },
    ),
    "te_producto_tec_cial": Adapter(
        "lineitem",
        {
            "cod_ramo_com": null_when("l_partkey % 89 = 0", text("l_partkey % 4")),
            "cod_producto_cial": text("l_partkey"),
            "cod_ramo": null_when("l_suppkey % 5 = 0", text("l_suppkey % 5")),
            "cod_producto_tec": decimal_text("l_suppkey"),
        },
    ),
    "tiso_producto": Adapter(
        "supplier",
        {
            "cod_ramo": null_when("s_suppkey % 5 = 0", text("s_suppkey % 5")),
            "cod_producto": text("s_suppkey"),
            "txt_desc": null_when("s_suppkey % 4 = 0", "s_name"),
            "cod_suc": text("s_nationkey"),
        },
    ),
}


class Sources(dict):
    """Source tables by name, each made when it is first asked for."""

    def __init__(self, adapters: dict[str, Adapter], spark: SparkSession, sf_dir: str):
        super().__init__()
        self.make = lambda name: adapters[name].frame(spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.make(name)
        return self[name]


def source_tables(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(ADAPTERS, spark, sf_dir)


def other_edition(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(OTHER_EDITION, spark, sf_dir)
