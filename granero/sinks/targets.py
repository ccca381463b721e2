"""Layouts of the target tables and the conversion of rows into them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.functions.numbers import scaled_div, scaled_int, trunc_int, trunc_int_or_zero

INT = T.IntegerType()
TEXT = T.StringType()

CONVERSIONS: dict[str, Callable[[Column], Column]] = {
    "int": lambda value: trunc_int(value, null="zero"),
    "lenient_int": trunc_int_or_zero,
    "scaled_int": scaled_div,
    "text": lambda value: value.cast("string"),
}


# The same for a column that is an int already.
TYPED_CONVERSIONS: dict[str, Callable[[Column], Column]] = {
    "int": lambda value: F.coalesce(value, F.lit(0)),
    "lenient_int": lambda value: F.coalesce(value, F.lit(0)),
    "scaled_int": lambda value: scaled_int(F.coalesce(value, F.lit(0))),
}


@dataclass(frozen=True)
class Field:
    """A target column.

    ``source`` is the row column it comes from; without one the column takes
    ``constant``, a typed null unless given.
    """

    name: str
    type: T.DataType
    source: str | None = None
    convert: str | None = None
    constant: int | None = None

    def column(self, row: T.StructType) -> Column:
        if self.source is None:
            value = F.lit(self.constant)
        else:
            typed = row[self.source].dataType == INT and self.convert in TYPED_CONVERSIONS
            conversions = TYPED_CONVERSIONS if typed else CONVERSIONS
            value = conversions[self.convert](F.col(self.source))
        return value.cast(self.type).alias(self.name)


@dataclass(frozen=True)
class Target:
    """A target table; ``keys`` and ``updates`` only where it is upserted.

    ``generated`` is an id column that the store assigns when rows are added.
    """

    name: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...] = ()
    updates: tuple[str, ...] = ()
    generated: str | None = None

    def rows(self, df: DataFrame) -> DataFrame:
        """Rows ready to be inserted, in the target's column order and types."""
        return df.select(*(field.column(df.schema) for field in self.fields))

    def order(self) -> list[Column]:
        """A total order of insert-ready rows: all columns but the constant ones."""
        return [F.col(field.name).asc_nulls_first() for field in self.fields if field.source]

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(field.name, field.type) for field in self.fields]
        if self.generated:
            fields.append(T.StructField(self.generated, T.IntegerType()))
        return T.StructType(fields)


# Names, types, order and constants of the target tables' columns.
PRODUCTO = Target(
    "Producto",
    (
        Field("RamoPlanId", INT, "RamoPlanId", "int"),
        Field("PlanTecnicoID", INT, "PlanTecnicoID", "int"),
        Field("PlanTecnico", TEXT, "PlanTecnico", "text"),
        Field("TipoProductoId", INT, constant=0),
        Field("CategoriaId", INT, constant=0),
        Field("RamoComercialID", INT, "RamoComercialID", "int"),
        Field("ProductoComercialID", INT, "ProductoComercialID", "int"),
        Field("ProductoComercial", TEXT, "ProductoComercial", "text"),
        Field("SucursalRamoComercialID", INT, "SucursalRamoComercialID", "int"),
        Field("EstadoHabilitado", INT, "EstadoHabilitado", "int"),
        Field("ProductoTecnicoId", INT, constant=0),
        Field("Moneda", TEXT),
    ),
    generated="ProductoId",
)

COBERTURA = Target(
    "Cobertura",
    (
        Field("GrupoCoberturaId", INT),
        Field("CoberturaId", INT, "CoberturaID", "int"),
        Field("Cobertura", TEXT, "Cobertura", "text"),
    ),
)

PRODUCTO_COBERTURA = Target(
    "ProductoCobertura",
    (
        Field("CoberturaId", INT, "CoberturaID", "int"),
        Field("TipoCoberturaId", TEXT),
        Field("ProductoId", INT, "ProductoId", "int"),
        Field("Monto", INT),
        Field("Deducible", INT),
        Field("Variable", INT),
    ),
)

CORREDOR = Target(
    "Corredor",
    (
        Field("AgenteID", INT, "AgenteID", "lenient_int"),
        Field("CorredorID", INT, "CorredorID", "lenient_int"),
        Field("CorredorDV", INT, "CorredorDV", "lenient_int"),
        Field("NombreCorredor", TEXT, "NombreCorredor", "text"),
    ),
    keys=("AgenteID", "CorredorID"),
    updates=("CorredorDV", "NombreCorredor"),
)

# CorredorId takes the agent's id, not the broker's.
PRODUCTO_CORREDOR = Target(
    "ProductoCorredor",
    (
        Field("ProductoId", INT, "ProductoId", "int"),
        Field("CorredorId", INT, "AgenteID", "int"),
        Field("Comision", INT, "PorcentajeComision", "scaled_int"),
        Field("EstadoHabilitado", INT, "EstadoHabilitado", "int"),
        Field("TipoAgenteId", INT),
    ),
)

TARGETS = (PRODUCTO, COBERTURA, PRODUCTO_COBERTURA, CORREDOR, PRODUCTO_CORREDOR)
