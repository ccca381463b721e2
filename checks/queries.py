"""One query per operator and flow, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import ADAPTERS, other_edition, source_tables
from granero.functions.keys import text_key, with_single_key
from granero.functions.numbers import is_numeric, scaled_div, trunc_int, trunc_int_or_zero
from granero.functions.text import default_missing, full_name, split_dv, to_text
from granero.operators.numbering import group_counter, surrogate_ids
from granero.operators.pairs import group_sizes, hot_cells
from granero.operators.project import emit_rows, rename
from granero.operators.skew import SkewPolicy
from granero.operators.upsert import upsert
from granero.plans import broker, coverage, product
from granero.plans.load import load_mart
from granero.sinks.mart import ParquetMart
from granero.sinks.targets import (
    COBERTURA,
    CORREDOR,
    PRODUCTO,
    PRODUCTO_COBERTURA,
    PRODUCTO_CORREDOR,
    TARGETS,
    Target,
)
from granero.sinks.text import text_dump
from granero.sources.jdbc import read_back
from granero.sources.snapshots import FileTable, SnapshotStore
from granero.sources.staging import stage, staging_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    # A name that an operator has already takes a trailing underscore here.
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def _in_order(columns: list[str]) -> list:
    return [F.col(name).asc_nulls_first() for name in columns]


def _with_ids(rows: DataFrame) -> DataFrame:
    return surrogate_ids(rows, PRODUCTO.order(), "ProductoId")


def _stored_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(_with_ids(product.producto_load(source_tables(spark, sf_dir))))


def _renamed(tables: dict[str, DataFrame]) -> DataFrame:
    return rename(tables["te_producto_cial"], product.PRODUCT_NAMES)


def _written(spark: SparkSession, target: Target, rows: DataFrame) -> DataFrame:
    mart = ParquetMart(spark, staging_path(spark))
    mart.append(target, rows)
    return mart.read(target)


def _bridged(tables: dict[str, DataFrame], key_mode: str = "text") -> DataFrame:
    sides = _renamed(tables), tables["te_producto_tec_cial"]
    cells = hot_cells(*sides, product.BRIDGE_ON, SkewPolicy())
    return product.product_bridge(*sides, key_mode, cells)


def _paid_agents(tables: dict[str, DataFrame], policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    sides = tables["te_producto_cial_comis"], tables["magente"]
    return broker.commission_agents(*sides, cells=hot_cells(*sides, broker.AGENT_ON, policy))


def _brokers(tables: dict[str, DataFrame], policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    # Stored, so that a repeated task deals its rows to the same cells.
    sides = tables["mpersona"], stage(_paid_agents(tables, policy))
    return broker.person_brokers(*sides, cells=hot_cells(*sides, broker.PERSON_ON, policy))


def _paid_products(spark: SparkSession, sf_dir: str, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    sides = _stored_products(spark, sf_dir), stage(_brokers(source_tables(spark, sf_dir), policy))
    return broker.product_brokers(*sides, cells=hot_cells(*sides, broker.PRODUCT_ON, policy))


def _covered_products(spark: SparkSession, sf_dir: str, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    covered = stage(coverage.coverages(source_tables(spark, sf_dir)))
    sides = _stored_products(spark, sf_dir), covered
    cells = hot_cells(*sides, coverage.PRODUCT_ON, policy)
    return coverage.product_coverages(*sides, cells=cells)


@query
def scan(spark, sf_dir):
    return source_tables(spark, sf_dir)["te_producto_cial"]


@query
def snapshot_scan(spark, sf_dir):
    store = SnapshotStore(spark, staging_path(spark))
    plans = source_tables(spark, sf_dir)["tiso_producto"]
    return store.take({"tiso_producto": plans})["tiso_producto"]


@query
def jdbc_scan_map(spark, sf_dir):
    return _stored_products(spark, sf_dir)


@query
def rename_(spark, sf_dir):
    return _renamed(source_tables(spark, sf_dir))


@query
def pair_project(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return _paid_agents(tables).select("cod_agente", "id_persona", "pje_comision", "cod_producto")


@query
def const_cols(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return product.producto_load(tables).select(
        "ProductoComercial",
        "TipoProductoId",
        "CategoriaId",
        "EstadoHabilitado",
        "ProductoTecnicoId",
        "Moneda",
    )


@query
def default_missing_(spark, sf_dir):
    return source_tables(spark, sf_dir)["tiso_producto"].select(
        "cod_producto", default_missing(F.col("txt_desc"), product.NO_PLAN).alias("PlanTecnico")
    )


@query
def null_to_zero(spark, sf_dir):
    return source_tables(spark, sf_dir)["te_producto_tec_cial"].select(
        "cod_producto_cial", trunc_int(F.col("cod_ramo_com"), null="zero").alias("RamoComercialID")
    )


@query
def trunc_int_(spark, sf_dir):
    return source_tables(spark, sf_dir)["te_producto_tec_cial"].select(
        "cod_producto_tec", trunc_int(F.col("cod_producto_tec")).alias("parsed")
    )


@query
def trunc_int_or_zero_(spark, sf_dir):
    number, _ = split_dv(F.col("nro_nit"))
    return source_tables(spark, sf_dir)["mpersona"].select(
        "nro_nit", trunc_int_or_zero(number).alias("CorredorID")
    )


@query
def is_numeric_(spark, sf_dir):
    return source_tables(spark, sf_dir)["mpersona"].select(
        "nro_nit", is_numeric(F.col("nro_nit")).cast("int").alias("is_numeric")
    )


@query
def scaled_div_(spark, sf_dir):
    return source_tables(spark, sf_dir)["te_producto_cial_comis"].select(
        "pje_comision", scaled_div(F.col("pje_comision")).alias("Comision")
    )


@query
def text_key_(spark, sf_dir):
    return source_tables(spark, sf_dir)["te_producto_tec_cial"].select(
        text_key(F.col("cod_ramo_com"), F.col("cod_producto_cial")).alias("key")
    )


@query
def single_key_drop(spark, sf_dir):
    return with_single_key(source_tables(spark, sf_dir)["ttarifa_producto"], "cod_tarifa")


@query
def split_dv_(spark, sf_dir):
    number, digit = split_dv(F.col("nro_nit"))
    return source_tables(spark, sf_dir)["mpersona"].select(
        "nro_nit", number.alias("CorredorID"), digit.alias("CorredorDV")
    )


@query
def full_name_(spark, sf_dir):
    parts = ["txt_nombre", "txt_apellido1", "txt_apellido2"]
    return source_tables(spark, sf_dir)["mpersona"].select(
        "id_persona", full_name(*(F.col(part) for part in parts)).alias("NombreCorredor")
    )


@query
def to_text_(spark, sf_dir):
    return source_tables(spark, sf_dir)["te_producto_tec_cial"].select(
        "cod_producto_cial",
        to_text(F.col("cod_producto_tec").cast("double")).alias("as_text"),
    )


@query
def cogroup_pairs(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return group_sizes(_renamed(tables), tables["te_producto_tec_cial"], product.BRIDGE_ON)


@query
def j1_product_bridge(spark, sf_dir):
    return _bridged(source_tables(spark, sf_dir))


@query
def j1_product_bridge_columns(spark, sf_dir):
    return _bridged(source_tables(spark, sf_dir), "columns")


@query
def j2_plan_product(spark, sf_dir):
    return product.product_rows(source_tables(spark, sf_dir))


@query
def j3_tariff_coverage(spark, sf_dir):
    return coverage.tariff_pairs(source_tables(spark, sf_dir))


@query
def first_per_text(spark, sf_dir):
    return coverage.coverages(source_tables(spark, sf_dir))


@query
def first_per_text_and_product(spark, sf_dir):
    return coverage.coverages(source_tables(spark, sf_dir), per="product")


@query
def j4_product_coverage(spark, sf_dir):
    return _covered_products(spark, sf_dir)


@query
def j5_commission_agent(spark, sf_dir):
    return _paid_agents(source_tables(spark, sf_dir))


@query
def j6_person_broker(spark, sf_dir):
    return _brokers(source_tables(spark, sf_dir))


@query
def j7_product_broker(spark, sf_dir):
    return _paid_products(spark, sf_dir)


@query
def group_counter_(spark, sf_dir):
    rows = product.product_rows(source_tables(spark, sf_dir))
    keys = ["RamoPlanId", "PlanTecnicoID"]
    others = [name for name in rows.columns if name not in keys]
    return group_counter(rows, keys, _in_order(others), "ProductoID")


@query
def surrogate_id(spark, sf_dir):
    return _with_ids(product.producto_load(source_tables(spark, sf_dir)))


@query
def row_fn(spark, sf_dir):
    parts = F.array("txt_nombre", "txt_apellido1", "txt_apellido2")
    persons = source_tables(spark, sf_dir)["mpersona"]
    return emit_rows(persons, ["id_persona"], F.array_compact(parts), "part")


@query
def sink_producto(spark, sf_dir):
    return _written(spark, PRODUCTO, product.producto_load(source_tables(spark, sf_dir)))


@query
def sink_cobertura(spark, sf_dir):
    covered = coverage.coverages(source_tables(spark, sf_dir))
    return _written(spark, COBERTURA, coverage.cobertura_load(covered))


@query
def sink_producto_cobertura(spark, sf_dir):
    return _written(spark, PRODUCTO_COBERTURA, f3_producto_cobertura(spark, sf_dir))


@query
def sink_producto_corredor(spark, sf_dir):
    return _written(spark, PRODUCTO_CORREDOR, f5_producto_corredor(spark, sf_dir))


@query
def upsert_corredor(spark, sf_dir):
    batch = stage(broker.corredor_load(source_tables(spark, sf_dir)))
    even = batch.where(F.col("AgenteID") % 2 == 0)
    stored = even.withColumn("CorredorDV", F.lit(5)).withColumn("NombreCorredor", F.lit("OLD"))
    unmatched = even.select(
        "AgenteID",
        F.lit(-1).alias("CorredorID"),
        F.lit(7).alias("CorredorDV"),
        F.lit("KEPT").alias("NombreCorredor"),
    ).distinct()
    keys, updates = list(CORREDOR.keys), list(CORREDOR.updates)
    return upsert(stored.unionByName(unmatched), batch, keys, updates)


@query
def sink_corredor(spark, sf_dir):
    mart = ParquetMart(spark, staging_path(spark))
    rows = broker.corredor_load(source_tables(spark, sf_dir))
    mart.upsert(CORREDOR, rows.withColumn("NombreCorredor", F.lit("OLD")))
    mart.upsert(CORREDOR, rows)
    return mart.read(CORREDOR)


@query
def text_dump_(spark, sf_dir):
    path = staging_path(spark)
    text_dump(coverage.coverages(source_tables(spark, sf_dir)), path)
    return spark.read.text(path)


@query
def f1_producto(spark, sf_dir):
    return product.producto_load(source_tables(spark, sf_dir))


@query
def f2_cobertura(spark, sf_dir):
    return coverage.cobertura_load(coverage.coverages(source_tables(spark, sf_dir)))


@query
def f3_producto_cobertura(spark, sf_dir):
    covered = stage(coverage.coverages(source_tables(spark, sf_dir)))
    return coverage.producto_cobertura_load(_stored_products(spark, sf_dir), covered)


@query
def f4_corredor(spark, sf_dir):
    return broker.corredor_load(source_tables(spark, sf_dir))


@query
def f5_producto_corredor(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return broker.producto_corredor_load(tables, _stored_products(spark, sf_dir))


@query
def f6_producto_alt(spark, sf_dir):
    return product.producto_load(other_edition(spark, sf_dir))


@query
def f7_all(spark, sf_dir):
    mart = ParquetMart(spark, staging_path(spark))
    tables = source_tables(spark, sf_dir)
    every = {name: tables[name] for name in ADAPTERS}
    load_mart(every, mart, SnapshotStore(spark, staging_path(spark)))
    sizes = [
        mart.read(target)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(target.name).alias("target"), "row_count")
        for target in TARGETS
    ]
    return reduce(DataFrame.unionByName, sizes)


def _digests(mart: ParquetMart) -> DataFrame:
    """Rows of every target, and the sum of 32 bits of each row's MD5, columns by name."""

    def digest(target: Target) -> DataFrame:
        texts = (F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in sorted(target.schema.names))
        first = F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8)
        bits = F.conv(first, 16, 10).cast("bigint")
        return mart.read(target).agg(
            F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(bits), F.lit(0)).alias("row_digest")
        ).select(F.lit(target.name).alias("target"), "row_count", "row_digest")

    return reduce(DataFrame.unionByName, map(digest, TARGETS))


@query
def f7_all_contents(spark, sf_dir):
    mart = ParquetMart(spark, staging_path(spark))
    tables = source_tables(spark, sf_dir)
    load_mart({name: tables[name] for name in ADAPTERS}, mart)
    return _digests(mart)


class _Fails(ParquetMart):
    """Loses its executors while it writes the last target."""

    def append(self, target, rows, batch_id=None):
        if target is PRODUCTO_CORREDOR:
            raise ConnectionError("executors lost")
        super().append(target, rows, batch_id)


@query
def f7_resumed_contents(spark, sf_dir):
    base, snapshots = staging_path(spark), SnapshotStore(spark, staging_path(spark))
    tables = source_tables(spark, sf_dir)
    every = {name: tables[name] for name in ADAPTERS}
    try:
        load_mart(every, _Fails(spark, base), snapshots, resume=True)
    except ConnectionError:
        load_mart(every, ParquetMart(spark, base), snapshots, resume=True)
    return _digests(ParquetMart(spark, base))


@query
def upsert_buckets(spark, sf_dir):
    """A second batch that meets some of the buckets and makes the table grow."""
    mart = ParquetMart(spark, staging_path(spark), rows_per_bucket=100, least_buckets=4)
    mart.upsert(CORREDOR, broker.corredor_load(source_tables(spark, sf_dir)))
    some = mart.read(CORREDOR).where(F.col("AgenteID") % 5 == 0)
    renamed = some.withColumn("NombreCorredor", F.lit("NEW"))
    added = some.withColumn("CorredorID", F.lit(-1)).withColumn("CorredorDV", F.lit(7))
    mart.upsert(CORREDOR, renamed.unionByName(added.withColumn("NombreCorredor", F.lit("ADDED")).distinct()))
    return mart.read(CORREDOR)


@query
def snapshot_files(spark, sf_dir):
    """The second snapshot of a table of files that has got more of them."""
    source, store = staging_path(spark), SnapshotStore(spark, staging_path(spark))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    parts.write.parquet(source)
    store.take({"part": FileTable(source)})
    parts.where("p_partkey % 3 = 0").write.mode("append").parquet(source)
    return store.take({"part": FileTable(source)}, "new")["part"]


# The same once more with small cells, so that many keys are split on any data.
SPLIT = SkewPolicy(pairs_per_cell=16, sample=1.0)
# Few agents share a person, so brokers take the smallest cells there are.
SPLIT_ALL = SkewPolicy(pairs_per_cell=1, sample=1.0)


@query
def j4_product_coverage_split(spark, sf_dir):
    return _covered_products(spark, sf_dir, SPLIT)


@query
def j6_person_broker_split(spark, sf_dir):
    return _brokers(source_tables(spark, sf_dir), SPLIT)


@query
def j7_product_broker_split(spark, sf_dir):
    return _paid_products(spark, sf_dir, SPLIT)


@query
def f1_producto_split(spark, sf_dir):
    return product.producto_load(source_tables(spark, sf_dir), policy=SPLIT)


@query
def f3_producto_cobertura_split(spark, sf_dir):
    covered = stage(coverage.coverages(source_tables(spark, sf_dir)))
    return coverage.producto_cobertura_load(
        _stored_products(spark, sf_dir), covered, "columns", SPLIT
    )


@query
def f4_corredor_split(spark, sf_dir):
    return broker.corredor_load(source_tables(spark, sf_dir), policy=SPLIT_ALL)


@query
def f4_corredor_split_columns(spark, sf_dir):
    return broker.corredor_load(source_tables(spark, sf_dir), "columns", SPLIT_ALL)


@query
def f5_producto_corredor_split(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return broker.producto_corredor_load(tables, _stored_products(spark, sf_dir), policy=SPLIT)


@query
def f5_producto_corredor_split_columns(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return broker.producto_corredor_load(
        tables, _stored_products(spark, sf_dir), "columns", SPLIT
    )
