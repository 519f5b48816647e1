"""Declared schemas of every input and result table, with the rules each result row must keep."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


# Fields of one vehicle report, in wire order.
REPORT = _struct(
    c=StringType, cl=IntegerType, sl=IntegerType, lt0=StringType, lt1=StringType, qv=IntegerType,
    p=IntegerType, a=BooleanType, ta=LongType, ta_tempo=StringType, py=DoubleType, px=DoubleType,
)

# A report plus the broker time it is ordered by, and an id that breaks ties between equal times.
POSITIONS = StructType(
    [StructField("event_id", LongType())] + REPORT.fields + [StructField("event_time", TimestampType())]
)

FEED_VEHICLE = _struct(p=IntegerType, a=BooleanType, ta=StringType, py=DoubleType, px=DoubleType)
FEED_LINE = StructType(
    _struct(c=StringType, cl=IntegerType, sl=IntegerType, lt0=StringType, lt1=StringType, qv=IntegerType).fields
    + [StructField("vs", ArrayType(FEED_VEHICLE))]
)
FEED = StructType([StructField("l", ArrayType(FEED_LINE))])

SHAPES = _struct(
    shape_id=StringType, shape_pt_lat=DoubleType, shape_pt_lon=DoubleType, shape_dist_traveled=DoubleType
)
TRIPS = _struct(route_id=StringType, shape_id=StringType, direction_id=IntegerType)
LOGS = _struct(ts=TimestampType, container=StringType, stream=StringType, line=StringType)


def avro_schema(record: str = "BusPosition", namespace: str = "sptrans") -> str:
    """Avro record for :data:`REPORT`; record name and namespace are fixed values of the wire contract."""
    names = {StringType: "string", IntegerType: "int", BooleanType: "boolean", LongType: "long", DoubleType: "double"}
    return json.dumps(
        {
            "type": "record",
            "namespace": namespace,
            "name": record,
            "fields": [{"name": f.name, "type": names[type(f.dataType)]} for f in REPORT.fields],
        }
    )


@dataclass(frozen=True)
class TableSpec:
    """A keyed result table: its key, columns, required columns and text widths."""

    name: str
    keys: tuple[str, ...]
    schema: StructType
    optional: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    updated: str = "ultima_atualizacao"

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [c for c in self.columns if c not in self.optional]


# Table and column names of the result tables that existing consumers read.
ACTIVE_VEHICLES = TableSpec(
    "tb_onibus_ativos_por_linha", ("linha",),
    _struct(linha=StringType, total_onibus_ativos=LongType, ultima_atualizacao=TimestampType),
    max_length={"linha": 50},
)
SPEED_BY_LINE = TableSpec(
    "tb_velocidade_por_linha", ("linha",),
    _struct(linha=StringType, velocidade_media=DoubleType, velocidade_maxima=DoubleType,
            velocidade_minima=DoubleType, ultima_atualizacao=TimestampType),
    max_length={"linha": 50},
)
SPEED_HISTORY = TableSpec(
    "tb_historico_velocidade_por_linha", ("linha", "janela_fim"),
    _struct(linha=StringType, janela_inicio=TimestampType, janela_fim=TimestampType, velocidade_media=DoubleType,
            velocidade_maxima=DoubleType, velocidade_minima=DoubleType),
    max_length={"linha": 50}, updated="janela_fim",
)
HEADWAY_BY_LINE = TableSpec(
    "tb_headway_por_linha", ("linha",),
    _struct(linha=StringType, headway_medio=DoubleType, headway_minimo=DoubleType, headway_maximo=DoubleType,
            ultima_atualizacao=TimestampType),
    max_length={"linha": 50},
)
HEADWAY_HISTORY = TableSpec(
    "tb_historico_headway_por_linha", ("linha", "janela_fim"),
    _struct(linha=StringType, janela_inicio=TimestampType, janela_fim=TimestampType, headway_medio=DoubleType,
            headway_minimo=DoubleType, headway_maximo=DoubleType),
    max_length={"linha": 50}, updated="janela_fim",
)
LATEST_POSITION = TableSpec(
    "tb_posicao_atual_onibus", ("prefixo",),
    _struct(prefixo=IntegerType, linha=StringType, letreiro_terminal=StringType, letreiro_origem=StringType,
            latitude=DoubleType, longitude=DoubleType, acessivel=BooleanType, ultima_atualizacao=TimestampType),
    optional=("letreiro_terminal", "letreiro_origem"),
    max_length={"linha": 50, "letreiro_terminal": 100, "letreiro_origem": 100},
)
VEHICLE_STATUS = TableSpec(
    "tb_veiculos_em_operacao", ("prefixo",),
    _struct(prefixo=IntegerType, linha=StringType, sentido=StringType, velocidade_kmh=DoubleType,
            headway_minutos=DoubleType, status=StringType, ultima_atualizacao=TimestampType),
    max_length={"linha": 50, "sentido": 10, "status": 20},
)
LINE_CATALOGUE = TableSpec(
    "tb_linhas_onibus_filtro", ("linha",),
    _struct(linha=StringType, letreiro_origem=StringType, letreiro_terminal=StringType, linha_descricao=StringType,
            ultima_atualizacao=TimestampType),
    optional=("letreiro_origem", "letreiro_terminal"),
    max_length={"linha": 50, "letreiro_origem": 100, "letreiro_terminal": 100, "linha_descricao": 250},
)

TABLES = {
    spec.name: spec
    for spec in (ACTIVE_VEHICLES, SPEED_BY_LINE, SPEED_HISTORY, HEADWAY_BY_LINE, HEADWAY_HISTORY, LATEST_POSITION,
                 VEHICLE_STATUS, LINE_CATALOGUE)
}
