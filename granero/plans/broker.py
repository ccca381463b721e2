"""Brokers behind commissions and their link to products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.keys import text_key
from granero.functions.numbers import checked_int, required, trunc_int, trunc_int_or_zero
from granero.functions.text import full_name, split_dv
from granero.operators import skew
from granero.operators.pairs import hot_cells, matched, pair_join
from granero.operators.upsert import one_per_key
from granero.sinks.targets import CORREDOR, PRODUCTO_CORREDOR
from granero.sources.staging import stage

Tables = dict[str, DataFrame]

AGENT_ON = [("cod_agente", "cod_agente"), ("cod_tipo_agente", "cod_tipo_agente")]
PERSON_ON = [("id_persona", "id_persona")]
PRODUCT_ON = [
    ("RamoComercialID", "RamoComercialID"),
    ("ProductoComercialID", "ProductoComercialID"),
]


def _key(columns: list[tuple[str, str]]):
    return text_key(*(F.col(name) for name, _ in columns))


def _with_broker(persons: DataFrame) -> DataFrame:
    """The person's id with the broker columns, made once per person."""
    number, digit = split_dv(F.col("nro_nit"))
    name = full_name(*(F.col(part) for part in ("txt_nombre", "txt_apellido1", "txt_apellido2")))
    return persons.select(
        "id_persona",
        number.alias("CorredorID"),
        digit.alias("CorredorDV"),
        name.alias("NombreCorredor"),
    )


def commission_agents(
    commissions: DataFrame,
    agents: DataFrame,
    key_mode: str = "text",
    cells: skew.Cells | None = None,
) -> DataFrame:
    """Commissions with the agent they are paid to."""
    joined = pair_join(commissions, agents, AGENT_ON, key_mode, cells)
    return joined.select(
        F.col("r.id_persona"),
        F.col("l.pje_comision"),
        F.col("r.cod_agente").alias("cod_agente"),
        F.col("l.cod_producto"),
        F.col("l.cod_ramo"),
    )


def person_brokers(
    persons: DataFrame,
    paid: DataFrame,
    key_mode: str = "text",
    cells: skew.Cells | None = None,
) -> DataFrame:
    """Broker rows: commissions of agents with the person behind the agent.

    A person without id meets every agent without one.
    """
    joined = pair_join(_with_broker(persons), paid, PERSON_ON, key_mode, cells)
    return joined.select(
        F.col("r.cod_agente").alias("AgenteID"),
        *(F.col(f"l.{name}") for name in ("CorredorID", "CorredorDV", "NombreCorredor")),
        F.col("r.pje_comision").alias("PorcentajeComision"),
        trunc_int(F.col("r.cod_producto")).alias("ProductoComercialID"),
        trunc_int(F.col("r.cod_ramo")).alias("RamoComercialID"),
    )


def product_brokers(
    producto: DataFrame,
    brokers: DataFrame,
    cells: skew.Cells | None = None,
) -> DataFrame:
    """Products (read back, with ids) with the commissions paid on them.

    Both key parts are ints on either side and never missing, so they match as
    their texts do.
    """
    joined = pair_join(
        producto.select("ProductoId", "EstadoHabilitado", *(name for name, _ in PRODUCT_ON)),
        brokers,
        PRODUCT_ON,
        "columns",
        cells,
    )
    return joined.select(
        F.col("l.ProductoId"),
        F.col("r.AgenteID").alias("AgenteID"),
        F.col("r.PorcentajeComision"),
        F.col("l.EstadoHabilitado"),
    )


def corredor_load(
    tables: Tables, key_mode: str = "text", policy: skew.SkewPolicy | None = skew.SkewPolicy()
) -> DataFrame:
    """Insert-ready rows of ``Corredor``, one per key: the upsert batch.

    A broker shows once per commission in ``person_brokers``, yet none of the
    commission is stored. So commissions only say which agents count, texts
    are turned into their stored form once per person or agent, and copies go
    before the two are joined. Of several rows of a key the greatest check
    digit, then the greatest name, is kept. A commission whose product or branch is
    no number fails the job if its agent and person exist, as it does there.
    """
    codes = (checked_int(F.col(name)).isNull() for name in ("cod_producto", "cod_ramo"))
    agents = (
        matched(
            tables["magente"],
            tables["te_producto_cial_comis"],
            AGENT_ON,
            key_mode,
            any_of=reduce(Column.__or__, codes),
        )
        .select("id_persona", trunc_int_or_zero(F.col("cod_agente")).alias("AgenteID"), "_any")
        .distinct()
    )
    persons = (
        _with_broker(tables["mpersona"])
        .withColumn("CorredorID", trunc_int_or_zero(F.col("CorredorID")))
        .withColumn("CorredorDV", trunc_int_or_zero(F.col("CorredorDV")))
        .distinct()
    )
    # Measured before copies go, which only makes for a few cells more.
    cells = hot_cells(tables["mpersona"], tables["magente"], PERSON_ON, policy)
    if cells:
        persons, agents = _placed_by_content(persons), _placed_by_content(agents)
    joined = pair_join(persons, agents, PERSON_ON, key_mode, cells)
    junk = F.raise_error(F.lit("number expected in cod_producto, cod_ramo")).cast("int")
    joined = joined.withColumn("AgenteID", F.when(F.col("_any"), junk).otherwise(F.col("AgenteID")))
    return one_per_key(CORREDOR.rows(joined), list(CORREDOR.keys), list(CORREDOR.updates))


def _placed_by_content(distinct: DataFrame) -> DataFrame:
    # Distinct rows need no number: their content tells them apart, and it does
    # not depend on the order in which a shuffle delivers them.
    return distinct.withColumn(skew.POSITION, F.xxhash64(*distinct.columns))


def agent_links(
    tables: Tables, key_mode: str = "text", policy: skew.SkewPolicy | None = skew.SkewPolicy()
) -> DataFrame:
    """Agents, once per person behind them, with the id to be stored.

    Staged: the planner then knows how large the links are and spares the
    commissions a shuffle where they can be broadcast. The id is null where it
    is no number.
    """
    persons = tables["mpersona"].select("id_persona")
    agents = tables["magente"]
    cells = hot_cells(persons, agents, PERSON_ON, policy)
    agents = agents.withColumn("_AgenteID", checked_int(F.col("cod_agente"), missing=0))
    links = pair_join(persons, agents, PERSON_ON, key_mode, cells)
    return stage(links.select("r.cod_agente", "r.cod_tipo_agente", "r._AgenteID"))


def broker_commissions(
    commissions: DataFrame,
    links: DataFrame,
    key_mode: str = "text",
    cells: skew.Cells | None = None,
) -> DataFrame:
    """``person_brokers`` over ``commission_agents``, as far as products need it.

    Agents and persons, both far smaller than the commissions, have been joined
    before (``agent_links``), so the commissions are shuffled once instead of
    twice; the pairs are the same. Numbers are parsed where they are stored and
    travel as ints. A commission that is no number is null, which matters only
    for rows that find a product.
    """
    parsed = commissions.select(
        "cod_agente",
        "cod_tipo_agente",
        checked_int(F.col("pje_comision"), missing=0).alias("_PorcentajeComision"),
        checked_int(F.col("cod_producto")).alias("_ProductoComercialID"),
        checked_int(F.col("cod_ramo")).alias("_RamoComercialID"),
        *(name for name in commissions.columns if name == skew.POSITION),
    )
    joined = pair_join(parsed, links, AGENT_ON, key_mode, cells)
    return joined.select(
        F.col("r._AgenteID").alias("AgenteID"),
        F.col("l._PorcentajeComision").alias("PorcentajeComision"),
        *(required(F.col(f"l._{name}"), name).alias(name) for name, _ in PRODUCT_ON),
        *(f"l.{name}" for name in commissions.columns if name == skew.POSITION),
    )


def producto_corredor_load(
    tables: Tables,
    producto: DataFrame,
    key_mode: str = "text",
    policy: skew.SkewPolicy | None = skew.SkewPolicy(),
) -> DataFrame:
    """Insert-ready rows of ``ProductoCorredor``; ``CorredorId`` is the agent's id.

    With a ``policy`` ``producto`` must be a stored table (see ``stage``).
    """
    commissions = tables["te_producto_cial_comis"]
    links = agent_links(tables, key_mode, policy)
    link_cells: skew.Cells = []
    product_cells: skew.Cells = []
    if policy:
        # Commissions stand for the broker rows, without joining them to count.
        product_key = text_key(
            trunc_int_or_zero(F.col("cod_ramo")), trunc_int_or_zero(F.col("cod_producto"))
        )
        found = skew.join_cells(
            [
                (commissions, {("link", "left"): _key(AGENT_ON), ("product", "right"): product_key}),
                (links, {("link", "right"): _key(AGENT_ON)}),
                (producto, {("product", "left"): _key(PRODUCT_ON)}),
            ],
            policy,
        )
        link_cells, product_cells = found["link"], found["product"]
        if product_cells:
            commissions = skew.with_position(commissions)
    brokers = broker_commissions(commissions, links, key_mode, link_cells)
    linked = product_brokers(producto, brokers, product_cells)
    numbers = {name: required(F.col(name), name) for name in ("AgenteID", "PorcentajeComision")}
    return PRODUCTO_CORREDOR.rows(linked.withColumns(numbers))
