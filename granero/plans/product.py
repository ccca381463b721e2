"""Commercial products, their technical plans, and the product load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.functions.keys import text_key
from granero.functions.numbers import checked_int, required, trunc_int, trunc_int_or_zero
from granero.functions.text import default_missing
from granero.operators import skew
from granero.operators.pairs import carried, pair_join
from granero.operators.project import rename
from granero.sinks.targets import PRODUCTO

Tables = dict[str, DataFrame]

# New column names, the plan text of a plan without one, the code
# of a missing commercial branch.
PRODUCT_NAMES = {"cod_producto": "nuevo_cod_producto", "txt_desc": "nuevo_txt_desc"}
NO_PLAN = "Sin Plan"
NO_BRANCH = "0"

BRIDGE_ON = [("cod_ramo", "cod_ramo_com"), ("nuevo_cod_producto", "cod_producto_cial")]
PLAN_ON = [("cod_ramo", "cod_ramo"), ("cod_producto", "cod_producto_tec")]


def product_bridge(
    products: DataFrame,
    bridge: DataFrame,
    key_mode: str = "text",
    cells: skew.Cells | None = None,
) -> DataFrame:
    """Technical products of each commercial product.

    ``products`` has the new column names. A technical product code that is
    missing or no number fails the job, if its row joins.
    """
    joined = pair_join(products, bridge, BRIDGE_ON, key_mode, cells)
    return joined.select(
        F.col("r.cod_ramo").alias("cod_ramo"),
        trunc_int(F.col("r.cod_producto_tec")).alias("cod_producto_tec"),
        default_missing(F.col("r.cod_ramo_com"), NO_BRANCH).alias("cod_ramo_com"),
        F.col("l.nuevo_cod_producto"),
        F.col("l.nuevo_txt_desc"),
        *carried(products, "l"),
        *carried(bridge, "r"),
    )


def plan_products(
    plans: DataFrame,
    bridged: DataFrame,
    key_mode: str = "text",
    cells: skew.Cells | None = None,
) -> DataFrame:
    """Product rows: each technical plan with the commercial products it carries.

    The right key part is the text of an int, so a plan code ``5.0`` meets none.
    """
    joined = pair_join(plans, bridged, PLAN_ON, key_mode, cells)
    return joined.select(
        F.col("l.cod_ramo").alias("RamoPlanId"),
        F.col("l.cod_producto").alias("PlanTecnicoID"),
        default_missing(F.col("l.txt_desc"), NO_PLAN).alias("PlanTecnico"),
        F.col("r.cod_ramo_com").alias("RamoComercialID"),
        F.col("r.nuevo_cod_producto").alias("ProductoComercialID"),
        F.col("r.nuevo_txt_desc").alias("ProductoComercial"),
        F.lit(0).alias("EstadoHabilitado"),
        F.col("l.cod_suc").alias("SucursalRamoComercialID"),
        *carried(plans, "l"),
        *carried(bridged.drop(skew.POSITION), "r"),
    )


def product_rows(
    tables: Tables, key_mode: str = "text", policy: skew.SkewPolicy | None = skew.SkewPolicy()
) -> DataFrame:
    """Both joins of the product load over ``te_producto_cial``,
    ``te_producto_tec_cial`` and ``tiso_producto``."""
    products = rename(tables["te_producto_cial"], PRODUCT_NAMES)
    bridge, plans = tables["te_producto_tec_cial"], tables["tiso_producto"]
    bridge_cells: skew.Cells = []
    plan_cells: skew.Cells = []
    if policy:
        found = skew.join_cells(
            [
                (products, {("bridge", "left"): text_key(*(F.col(name) for name, _ in BRIDGE_ON))}),
                (
                    bridge,
                    {
                        ("bridge", "right"): text_key(*(F.col(name) for _, name in BRIDGE_ON)),
                        # Stands for the bridged rows, without joining them to count.
                        ("plan", "right"): text_key(
                            F.col("cod_ramo"), trunc_int_or_zero(F.col("cod_producto_tec"))
                        ),
                    },
                ),
                (plans, {("plan", "left"): text_key(*(F.col(name) for name, _ in PLAN_ON))}),
            ],
            policy,
        )
        bridge_cells, plan_cells = found["bridge"], found["plan"]
        if plan_cells:
            bridge = skew.with_position(bridge)
    bridged = product_bridge(products, bridge, key_mode, bridge_cells)
    return plan_products(plans, bridged, key_mode, plan_cells)


def producto_load(
    tables: Tables, key_mode: str = "text", policy: skew.SkewPolicy | None = skew.SkewPolicy()
) -> DataFrame:
    """Insert-ready rows of ``Producto``.

    The tables may be any edition of the three sources; which ones is up to the
    caller.
    """
    numbers = {
        "te_producto_cial": {"ProductoComercialID": F.col("cod_producto")},
        "te_producto_tec_cial": {
            "RamoComercialID": default_missing(F.col("cod_ramo_com"), NO_BRANCH)
        },
        "tiso_producto": {
            "RamoPlanId": F.col("cod_ramo"),
            "PlanTecnicoID": F.col("cod_producto"),
            "SucursalRamoComercialID": F.col("cod_suc"),
        },
    }
    # Parsed where they are stored, held to be numbers once they have joined.
    parsed = {
        table: tables[table].withColumns(
            {f"_{name}": checked_int(value, missing=0) for name, value in columns.items()}
        )
        for table, columns in numbers.items()
    }
    rows = product_rows(parsed, key_mode, policy)
    return PRODUCTO.rows(
        rows.withColumns(
            {
                name: required(F.col(f"_{name}"), name)
                for columns in numbers.values()
                for name in columns
            }
        )
    )
