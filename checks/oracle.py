"""The same answers in DuckDB SQL, written step by step as the flows are stated."""

from __future__ import annotations

from checks.adapters import ADAPTERS, OTHER_EDITION, Adapter
from granero.sinks.targets import TARGETS, Target


def _int(text: str) -> str:
    bounded = f"greatest(least(trunc(CAST({text} AS DOUBLE)), 2147483647), -2147483648)"
    return f"CASE WHEN {text} IS NOT NULL THEN CAST({bounded} AS INTEGER) END"


def _int_or_zero(text: str) -> str:
    return f"coalesce({_int(text)}, 0)"


def _numeric(text: str) -> str:
    return (
        f"coalesce(regexp_full_match({text}, "
        r"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?'), false)"
    )


def _lenient(text: str) -> str:
    number = f"TRY_CAST({text} AS DOUBLE)"
    return f"CASE WHEN {_numeric(text)} THEN {_int(number)} ELSE 0 END"


def _key(*parts: str) -> str:
    return " || '-' || ".join(f"coalesce(CAST({part} AS VARCHAR), 'null')" for part in parts)


def _trim(text: str) -> str:
    return rf"regexp_replace(coalesce({text}, ''), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


PRODUCT_COLUMNS = (
    "RamoPlanId, PlanTecnicoID, PlanTecnico, TipoProductoId, CategoriaId, RamoComercialID, "
    "ProductoComercialID, ProductoComercial, SucursalRamoComercialID, EstadoHabilitado, "
    "ProductoTecnicoId, Moneda"
)
PRODUCT_ORDER = ", ".join(f"{name} NULLS FIRST" for name in PRODUCT_COLUMNS.split(", "))

SPLIT_ID = (
    "CASE WHEN coalesce(nro_nit, '') = '' THEN '' ELSE left(nro_nit, length(nro_nit) - 1) END"
)
SPLIT_DIGIT = "CASE WHEN coalesce(nro_nit, '') = '' THEN '' ELSE upper(right(nro_nit, 1)) END"
NAME = " || ' ' || ".join(_trim(part) for part in ("txt_nombre", "txt_apellido1", "txt_apellido2"))

# Each step reads source tables and earlier steps.
# The columns of the steps, by name and in order, and the constants in them.
STEPS = {
    "j1": f"""
        SELECT b.cod_ramo, {_int('b.cod_producto_tec')} AS cod_producto_tec,
               coalesce(b.cod_ramo_com, '0') AS cod_ramo_com,
               p.cod_producto AS nuevo_cod_producto, p.txt_desc AS nuevo_txt_desc
        FROM te_producto_cial p JOIN te_producto_tec_cial b
          ON {_key('p.cod_ramo', 'p.cod_producto')} = {_key('b.cod_ramo_com', 'b.cod_producto_cial')}""",
    "j2": f"""
        SELECT t.cod_ramo AS RamoPlanId, t.cod_producto AS PlanTecnicoID,
               coalesce(t.txt_desc, 'Sin Plan') AS PlanTecnico,
               j.cod_ramo_com AS RamoComercialID, j.nuevo_cod_producto AS ProductoComercialID,
               j.nuevo_txt_desc AS ProductoComercial, CAST(0 AS INTEGER) AS EstadoHabilitado,
               t.cod_suc AS SucursalRamoComercialID
        FROM tiso_producto t JOIN j1 j
          ON {_key('t.cod_ramo', 't.cod_producto')} = {_key('j.cod_ramo', 'j.cod_producto_tec')}""",
    "f1": f"""
        SELECT {_int_or_zero('RamoPlanId')} AS RamoPlanId,
               {_int_or_zero('PlanTecnicoID')} AS PlanTecnicoID, PlanTecnico,
               CAST(0 AS INTEGER) AS TipoProductoId, CAST(0 AS INTEGER) AS CategoriaId,
               {_int_or_zero('RamoComercialID')} AS RamoComercialID,
               {_int_or_zero('ProductoComercialID')} AS ProductoComercialID, ProductoComercial,
               {_int_or_zero('SucursalRamoComercialID')} AS SucursalRamoComercialID,
               EstadoHabilitado, CAST(0 AS INTEGER) AS ProductoTecnicoId,
               CAST(NULL AS VARCHAR) AS Moneda
        FROM j2""",
    "producto": f"""
        SELECT CAST(row_number() OVER (ORDER BY {PRODUCT_ORDER}) AS INTEGER) AS ProductoId,
               {PRODUCT_COLUMNS}
        FROM f1""",
    "j3": f"""
        SELECT t.cod_tarifa AS CoberturaID, coalesce(t.txt_desc, '') AS Cobertura,
               {_int("coalesce(p.cod_ramo, '0')")} AS RamoPlanID,
               coalesce(p.cod_producto, '0') AS PlanTecnicoID
        FROM ttarifa_producto p JOIN ttarifa t ON p.cod_tarifa = t.cod_tarifa""",
    "d1": """
        SELECT CoberturaID, Cobertura, RamoPlanID, PlanTecnicoID
        FROM (SELECT *, row_number() OVER (PARTITION BY CoberturaID, Cobertura
                                           ORDER BY RamoPlanID, PlanTecnicoID) AS place
              FROM j3)
        WHERE place = 1""",
    "f2": f"""
        SELECT CAST(NULL AS INTEGER) AS GrupoCoberturaId, {_int('CoberturaID')} AS CoberturaId,
               Cobertura
        FROM d1""",
    "j4": f"""
        SELECT p.ProductoId, c.CoberturaID
        FROM producto p JOIN d1 c
          ON {_key('p.RamoPlanId', 'p.PlanTecnicoID')} = {_key('c.RamoPlanID', 'c.PlanTecnicoID')}""",
    "f3": f"""
        SELECT {_int('CoberturaID')} AS CoberturaId, CAST(NULL AS VARCHAR) AS TipoCoberturaId,
               ProductoId, CAST(NULL AS INTEGER) AS Monto, CAST(NULL AS INTEGER) AS Deducible,
               CAST(NULL AS INTEGER) AS Variable
        FROM j4""",
    "j5": f"""
        SELECT a.id_persona, c.pje_comision, a.cod_agente, c.cod_producto, c.cod_ramo
        FROM te_producto_cial_comis c JOIN magente a
          ON {_key('c.cod_agente', 'c.cod_tipo_agente')} = {_key('a.cod_agente', 'a.cod_tipo_agente')}""",
    "j6": f"""
        SELECT j.cod_agente AS AgenteID, {SPLIT_ID} AS CorredorID, {SPLIT_DIGIT} AS CorredorDV,
               upper({NAME}) AS NombreCorredor, j.pje_comision AS PorcentajeComision,
               {_int('j.cod_producto')} AS ProductoComercialID,
               {_int('j.cod_ramo')} AS RamoComercialID
        FROM mpersona m JOIN j5 j
          ON coalesce(m.id_persona, 'null') = coalesce(j.id_persona, 'null')""",
    "f4": f"""
        SELECT AgenteID, CorredorID, CorredorDV, NombreCorredor
        FROM (SELECT *, row_number() OVER (PARTITION BY AgenteID, CorredorID
                                           ORDER BY CorredorDV DESC, NombreCorredor DESC) AS place
              FROM (SELECT {_lenient('AgenteID')} AS AgenteID,
                           {_lenient('CorredorID')} AS CorredorID,
                           {_lenient('CorredorDV')} AS CorredorDV, NombreCorredor
                    FROM j6))
        WHERE place = 1""",
    "j7": """
        SELECT p.ProductoId, b.AgenteID, b.PorcentajeComision, p.EstadoHabilitado
        FROM producto p JOIN j6 b
          ON p.RamoComercialID = b.RamoComercialID
         AND p.ProductoComercialID = b.ProductoComercialID""",
    "f5": f"""
        SELECT ProductoId, {_int_or_zero('AgenteID')} AS CorredorId,
               CAST({_int_or_zero('PorcentajeComision')} // 1000000 AS INTEGER) AS Comision,
               EstadoHabilitado, CAST(NULL AS INTEGER) AS TipoAgenteId
        FROM j7""",
}


def sql(final: str, sources: dict[str, Adapter] = ADAPTERS) -> str:
    views = {name: adapter.sql() for name, adapter in sources.items()}
    steps = {
        name: step
        for name, step in STEPS.items()
        if sources is ADAPTERS or name in ("j1", "j2", "f1")
    }
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in (views | steps).items())
    return f"WITH {ctes}\n{final}"


def _all(step: str) -> str:
    return sql(f"SELECT * FROM {step}")


STORED = {
    "Producto": "producto",
    "Cobertura": "f2",
    "ProductoCobertura": "f3",
    "Corredor": "f4",
    "ProductoCorredor": "f5",
}

COUNTED = " UNION ALL ".join(
    f"SELECT '{target}' AS target, count(*) AS row_count FROM {step}"
    for target, step in STORED.items()
)


def _digest(target: Target) -> str:
    """32 bits of a row's MD5, columns by name."""
    parts = ", ".join(f"coalesce(CAST({name} AS VARCHAR), '~')" for name in sorted(target.schema.names))
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 8) AS BIGINT)"


# Digests of all rows add up, so every value of every stored row counts.
DIGESTED = " UNION ALL ".join(
    f"SELECT '{target.name}' AS target, count(*) AS row_count, "
    f"CAST(coalesce(sum({_digest(target)}), 0) AS BIGINT) AS row_digest FROM {STORED[target.name]}"
    for target in TARGETS
)

ORACLE = {
    "scan": _all("te_producto_cial"),
    "snapshot_scan": _all("tiso_producto"),
    "jdbc_scan_map": sql(
        """
        SELECT RamoPlanId AS RamoPlanID, PlanTecnicoID, PlanTecnico, TipoProductoId, CategoriaId,
               RamoComercialID, ProductoComercialID, ProductoComercial, SucursalRamoComercialID,
               EstadoHabilitado, ProductoId, ProductoTecnicoId, Moneda
        FROM producto"""
    ),
    "rename": sql(
        """
        SELECT cod_ramo, cod_producto AS nuevo_cod_producto, txt_desc AS nuevo_txt_desc
        FROM te_producto_cial"""
    ),
    "pair_project": sql("SELECT cod_agente, id_persona, pje_comision, cod_producto FROM j5"),
    "const_cols": sql(
        """
        SELECT ProductoComercial, TipoProductoId, CategoriaId, EstadoHabilitado,
               ProductoTecnicoId, Moneda
        FROM f1"""
    ),
    "default_missing": sql(
        "SELECT cod_producto, coalesce(txt_desc, 'Sin Plan') AS PlanTecnico FROM tiso_producto"
    ),
    "null_to_zero": sql(
        f"""
        SELECT cod_producto_cial, {_int_or_zero('cod_ramo_com')} AS RamoComercialID
        FROM te_producto_tec_cial"""
    ),
    "trunc_int": sql(
        f"SELECT cod_producto_tec, {_int('cod_producto_tec')} AS parsed FROM te_producto_tec_cial"
    ),
    "trunc_int_or_zero": sql(
        f"""
        SELECT nro_nit, {_lenient('number')} AS CorredorID
        FROM (SELECT nro_nit, {SPLIT_ID} AS number FROM mpersona)"""
    ),
    "is_numeric": sql(
        f"SELECT nro_nit, CAST({_numeric('nro_nit')} AS INTEGER) AS is_numeric FROM mpersona"
    ),
    "scaled_div": sql(
        f"""
        SELECT pje_comision, CAST({_int_or_zero('pje_comision')} // 1000000 AS INTEGER) AS Comision
        FROM te_producto_cial_comis"""
    ),
    "text_key": sql(
        f"SELECT {_key('cod_ramo_com', 'cod_producto_cial')} AS key FROM te_producto_tec_cial"
    ),
    "single_key_drop": sql(
        """
        SELECT cod_tarifa, cod_ramo, cod_producto, cod_tarifa AS key
        FROM ttarifa_producto WHERE cod_tarifa IS NOT NULL"""
    ),
    "split_dv": sql(
        f"SELECT nro_nit, {SPLIT_ID} AS CorredorID, {SPLIT_DIGIT} AS CorredorDV FROM mpersona"
    ),
    "full_name": sql(
        f"SELECT id_persona, upper({NAME}) AS NombreCorredor FROM mpersona"
    ),
    "to_text": sql(
        """
        SELECT cod_producto_cial, CAST(CAST(cod_producto_tec AS DOUBLE) AS VARCHAR) AS as_text
        FROM te_producto_tec_cial"""
    ),
    "cogroup_pairs": sql(
        f"""
        SELECT key, CAST(sum(a) AS BIGINT) AS left_rows, CAST(sum(b) AS BIGINT) AS right_rows,
               CAST(sum(a) * sum(b) AS BIGINT) AS pairs
        FROM (SELECT {_key('cod_ramo', 'cod_producto')} AS key, 1 AS a, 0 AS b
              FROM te_producto_cial
              UNION ALL
              SELECT {_key('cod_ramo_com', 'cod_producto_cial')}, 0, 1 FROM te_producto_tec_cial)
        GROUP BY key"""
    ),
    "j1_product_bridge": _all("j1"),
    "j1_product_bridge_columns": sql(
        f"""
        SELECT b.cod_ramo, {_int('b.cod_producto_tec')} AS cod_producto_tec,
               coalesce(b.cod_ramo_com, '0') AS cod_ramo_com,
               p.cod_producto AS nuevo_cod_producto, p.txt_desc AS nuevo_txt_desc
        FROM te_producto_cial p JOIN te_producto_tec_cial b
          ON p.cod_ramo IS NOT DISTINCT FROM b.cod_ramo_com
         AND p.cod_producto IS NOT DISTINCT FROM b.cod_producto_cial"""
    ),
    "j2_plan_product": _all("j2"),
    "j3_tariff_coverage": _all("j3"),
    "first_per_text": _all("d1"),
    "first_per_text_and_product": sql("SELECT DISTINCT * FROM j3"),
    "j4_product_coverage": _all("j4"),
    "j5_commission_agent": _all("j5"),
    "j6_person_broker": _all("j6"),
    "j7_product_broker": _all("j7"),
    "group_counter": sql(
        """
        SELECT *, CAST(row_number() OVER (
            PARTITION BY RamoPlanId, PlanTecnicoID
            ORDER BY PlanTecnico NULLS FIRST, RamoComercialID NULLS FIRST,
                     ProductoComercialID NULLS FIRST, ProductoComercial NULLS FIRST,
                     EstadoHabilitado, SucursalRamoComercialID NULLS FIRST) AS INTEGER)
            AS ProductoID
        FROM j2"""
    ),
    "surrogate_id": _all("producto"),
    "row_fn": sql(
        """
        SELECT id_persona, txt_nombre AS part FROM mpersona WHERE txt_nombre IS NOT NULL
        UNION ALL
        SELECT id_persona, txt_apellido1 FROM mpersona WHERE txt_apellido1 IS NOT NULL
        UNION ALL
        SELECT id_persona, txt_apellido2 FROM mpersona WHERE txt_apellido2 IS NOT NULL"""
    ),
    "sink_producto": _all("producto"),
    "sink_cobertura": _all("f2"),
    "sink_producto_cobertura": _all("f3"),
    "sink_producto_corredor": _all("f5"),
    "upsert_corredor": sql(
        """
        SELECT * FROM f4
        UNION ALL
        SELECT DISTINCT AgenteID, CAST(-1 AS INTEGER), CAST(7 AS INTEGER), 'KEPT'
        FROM f4 WHERE AgenteID % 2 = 0"""
    ),
    "sink_corredor": _all("f4"),
    "text_dump": sql(
        """
        SELECT '{"CoberturaID":"' || CoberturaID || '","Cobertura":"' || Cobertura
               || '","RamoPlanID":' || RamoPlanID || ',"PlanTecnicoID":"' || PlanTecnicoID
               || '"}' AS value
        FROM d1"""
    ),
    "f1_producto": _all("f1"),
    "f2_cobertura": _all("f2"),
    "f3_producto_cobertura": _all("f3"),
    "f4_corredor": _all("f4"),
    "f5_producto_corredor": _all("f5"),
    "f6_producto_alt": sql("SELECT * FROM f1", OTHER_EDITION),
    "f7_all": sql(COUNTED),
    "f7_all_contents": sql(DIGESTED),
    "f7_resumed_contents": sql(DIGESTED),
    "snapshot_files": sql(
        "SELECT p_partkey, p_name FROM part UNION ALL SELECT p_partkey, p_name FROM part WHERE p_partkey % 3 = 0"
    ),
    "upsert_buckets": sql(
        """
        SELECT AgenteID, CorredorID, CorredorDV,
               CASE WHEN AgenteID % 5 = 0 THEN 'NEW' ELSE NombreCorredor END AS NombreCorredor
        FROM f4
        UNION ALL
        SELECT DISTINCT AgenteID, CAST(-1 AS INTEGER), CAST(7 AS INTEGER), 'ADDED'
        FROM f4 WHERE AgenteID % 5 = 0"""
    ),
}

# The same results, whatever keys are split.
ORACLE |= {
    f"{name}_split": ORACLE[name]
    for name in (
        "j4_product_coverage",
        "j6_person_broker",
        "j7_product_broker",
        "f1_producto",
        "f3_producto_cobertura",
        "f4_corredor",
        "f5_producto_corredor",
    )
}
ORACLE |= {f"{name}_split_columns": ORACLE[name] for name in ("f4_corredor", "f5_producto_corredor")}
