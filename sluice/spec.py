"""Typed record declarations: an ordered list of field specs -> StructType / DDL.

Support code for the record operators (validation, TSV codec, mapping).
"""

from __future__ import annotations

from dataclasses import dataclass, field as dc_field

from pyspark.sql import types as T

KINDS = ("string", "delimited", "boolean", "integer", "date", "datetime", "float")

_SPARK_TYPES = {
    "string": T.StringType(),
    "delimited": T.ArrayType(T.StringType()),
    "boolean": T.BooleanType(),
    "integer": T.LongType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "float": T.DoubleType(),
}
_SQL_TYPES = {
    "delimited": "VARCHAR", "boolean": "BOOLEAN", "integer": "INT", "date": "DATE",
    "datetime": "DATETIME", "float": "FLOAT",
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    nullable: bool = True
    length: int | None = None
    truncate: bool = False
    normalize_whitespace: bool = False

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown field kind {self.kind!r}")
        if self.length is not None and self.length <= 0:
            raise ValueError("Length must be greater than 0")
        if self.truncate and self.length is None:
            raise ValueError("truncate needs a length")

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.kind]

    @property
    def sql_type(self) -> str:
        if self.kind == "string":
            base = f"VARCHAR({self.length})" if self.length else "VARCHAR"
        else:
            base = _SQL_TYPES[self.kind]
        return base if self.nullable else base + " NOT NULL"


def StringField(name, length=None, truncate=False, nullable=True, normalize_whitespace=False):
    return Field(name, "string", nullable, length, truncate, normalize_whitespace)


def DelimitedStringField(name, nullable=True):
    return Field(name, "delimited", nullable)


def BooleanField(name, nullable=True):
    return Field(name, "boolean", nullable)


def IntegerField(name, nullable=True):
    return Field(name, "integer", nullable)


def DateField(name, nullable=True):
    return Field(name, "date", nullable)


def DateTimeField(name, nullable=True):
    return Field(name, "datetime", nullable)


def FloatField(name, nullable=True):
    return Field(name, "float", nullable)


@dataclass(frozen=True)
class RecordSpec:
    fields: tuple[Field, ...] = dc_field(default_factory=tuple)

    def __init__(self, *fields: Field):
        names = [f.name for f in fields]
        if len(set(names)) != len(names):
            raise ValueError("duplicate field names")
        object.__setattr__(self, "fields", tuple(fields))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def __getitem__(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields])

    def ddl(self) -> str:
        return ", ".join(f"{f.name} {f.spark_type.simpleString()}" for f in self.fields)

    def sql_columns(self) -> list[tuple[str, str]]:
        return [(f.name, f.sql_type) for f in self.fields]
