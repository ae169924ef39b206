"""Schemas of the input files, with canonical column names."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Header names of production files, in file order -> canonical name.
PRODUCTION_HEADERS = {
    "Data de Produção": "prod_date",
    "Cód. Ordem": "order_id",
    "Cód. Recurso": "resource",
    "Cód. Produto": "product",
    "Qtd. Produzida": "qty_produced",
    "Qtd. Refugada": "qty_scrapped",
    "Qtd. Retrabalhada": "qty_reworked",
    "Fator Un.": "unit_factor",
    "Cód. Un.": "unit",
    "Descrição da massa (Composto)": "compound",
    "Consumo de massa no item em (Kg/100pçs)": "mass_kg_per_100",
}
# Headers that may stand in for a missing compound, in order of preference.
COMPOUND_FALLBACKS = ("Descrição", "Nome. Produto")
MISSING_COMPOUND = "N/A"
# Date layouts of the files, day first.
DATE_FORMATS = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
# Fixed value: prefix of a valid entity.
ENTITY_PREFIX = "EQ-"

PRODUCTION_TYPES = {
    "prod_date": "string", "order_id": "bigint", "resource": "string", "product": "string",
    "qty_produced": "bigint", "qty_scrapped": "bigint", "qty_reworked": "bigint", "unit_factor": "double",
    "unit": "string", "compound": "string", "mass_kg_per_100": "double",
}
PRODUCTION = _struct(
    prod_date=S, order_id=L, resource=S, product=S, qty_produced=L, qty_scrapped=L, qty_reworked=L,
    unit_factor=D, unit=S, compound=S, mass_kg_per_100=D,
)
# The maintenance sheet is read by position: its header repeats names.
MAINTENANCE = _struct(
    entity=S, last_replacement=S, previous_replacement=S, days_in_operation=S, notes=S,
    a_p1=S, a_p2=S, a_p3=S, a_p4=S, a_p5=S, a_max=S, a_min=S,
    b_p1=S, b_p2=S, b_p3=S, b_p4=S, b_max=S, b_min=S,
)
PREVENTIVE = _struct(entity=S, group=S, event_type=S, request_no=S, event_date=S, order=S)
SIMPLE_MAINTENANCE = _struct(equipamento=S, data_manutencao=T.DateType(), tipo=S, descricao=S)
RUN_LOG = _struct(run_id=S, ts=T.TimestampType(), step=S, model=S, mse=D, r2=D, accuracy=D)
SNAPSHOT = _struct(category=S, name=S, path=S, size=L, modified=T.TimestampType(), hash=S)

# Last known replacement and interval in days per entity, used where a file lacks them.
DEFAULT_MAINTENANCE = """
EQ-101 2024-03-15 365
EQ-102 2024-06-20 343
EQ-103 2024-09-10 496
EQ-104 2024-07-05 385
EQ-105 2024-06-28 379
EQ-106 2024-08-15 406
EQ-107 2024-10-01 490
EQ-108 2024-09-20 448
EQ-109 2024-07-01 384
EQ-110 2024-05-10 332
EQ-111 2024-04-25 395
EQ-112 2024-08-30 433
EQ-113 2025-01-15 504
EQ-114 2024-06-20 356
EQ-115 2024-08-05 419
EQ-116 2024-10-15 490
EQ-117 2024-11-20 523
EQ-118 2024-10-20 492
EQ-119 2025-02-10 532
EQ-120 2024-12-15 538
EQ-121 2024-12-15 539
EQ-122 2024-06-15 342
EQ-123 2025-01-05 569
EQ-124 2024-11-25 526
EQ-125 2024-07-10 357
EQ-126 2025-01-20 510
EQ-127 2024-08-10 406
"""
