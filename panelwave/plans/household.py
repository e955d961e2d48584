"""Preset for the quarterly household survey: columns, codes, rules and labels."""

from __future__ import annotations

from panelwave.spec import Control, PanelSpec, Rule

# Raw columns of the survey files with their types.
TYPES = {
    "ANIO": "int",
    "TRIMESTRE": "int",
    "DOMINIO": "int",
    "NUM_HOGAR": "bigint",
    "NUM_PERSONA": "bigint",
    "FACTOR": "double",
    "P02A03": "double",
    "P03A03A": "int",
    "P05C07A": "double",
    "P05C07B": "double",
    "P05H01A": "double",
    "P05C16": "int",
    "OCUPADOS": "int",
    "P05D01": "double",
}
# Valid codes, all rows and eligible rows.
AUDITED_CODES = {
    "DOMINIO": (1, 2, 3),
    "P03A03A": (0, 1, 2, 3, 4, 5, 6, 7),
    "P05C16": (1, 2, 3, 4, 5, 6, 7, 8, 9),
    "OCUPADOS": (1,),
}
CATEGORIES = {
    "nivel_educativo": ("P03A03A", (0, 1, 2, 3, 4, 5, 6, 7)),
    "categoria_ocupacional": ("P05C16", (1, 2, 3, 4)),
    "dominio": ("DOMINIO", (1, 2, 3)),
}
# Labels of the category codes.
LABELS = {
    "nivel_educativo": {
        "0": "Ninguno",
        "1": "Preprimaria",
        "2": "Primaria",
        "3": "Básico",
        "4": "Diversificado",
        "5": "Superior",
        "6": "Maestría",
        "7": "Doctorado",
    },
    "categoria_ocupacional": {
        "1": "Empleado de gobierno",
        "2": "Empleado de empresa privada",
        "3": "Jornalero o peón",
        "4": "Servicio doméstico",
    },
    "dominio": {"1": "Urbano Metropolitano", "2": "Resto Urbano", "3": "Rural Nacional"},
}
# The eligibility rules in their order.
RULES = (
    Rule("1_edad", "P02A03 >= 15"),
    Rule("2_ocupado_categoria", "OCUPADOS = 1 and P05C16 in (1, 2, 3, 4)"),
    Rule("3_salario", "P05D01 > 0"),
    Rule(
        "4_antiguedad_componentes",
        "P05C07A >= 0 and P05C07B = floor(P05C07B) and P05C07B between 0 and 11",
    ),
    Rule("5_antiguedad_edad", "P05C07A + P05C07B / 12.0D <= P02A03"),
    Rule("6_horas", "P05H01A > 0 and P05H01A <= 168"),
)
# Conditions no eligible row may meet.
VIOLATIONS = {
    "edad_menor_15": "edad < 15",
    "salario_no_positivo": "salario_mensual <= 0",
    "horas_fuera_rango": "horas_semanales <= 0 or horas_semanales > 168",
    "antiguedad_negativa": "antiguedad < 0",
    "antiguedad_mayor_edad": "antiguedad > edad",
    "ocupados_distinto_1": "OCUPADOS <> 1",
    "categoria_fuera_1_4": "categoria_ocupacional not in ('1', '2', '3', '4')",
    "nivel_educativo_fuera_0_7": "nivel_educativo not in ('0', '1', '2', '3', '4', '5', '6', '7')",
    "dominio_fuera_1_3": "dominio not in ('1', '2', '3')",
    "anio_archivo_incoherente": "anio_archivo <> cast(substr(periodo_archivo, 1, 4) as int)",
}
# Schema of the eligible table.
ELIGIBLE_SCHEMA = {
    "id_registro": "string",
    "archivo_origen": "string",
    "periodo_archivo": "string",
    "anio_archivo": "int",
    "trimestre_calendario": "int",
    "fila_origen": "int",
    "ANIO": "int",
    "TRIMESTRE": "int",
    "NUM_HOGAR": "bigint",
    "NUM_PERSONA": "bigint",
    "FACTOR": "double",
    "edad": "double",
    "antiguedad": "double",
    "horas_semanales": "double",
    "salario_mensual": "double",
    "nivel_educativo": "string",
    "categoria_ocupacional": "string",
    "dominio": "string",
    "P03A03A": "int",
    "P05C16": "int",
    "codigo_dominio": "int",
    "OCUPADOS": "int",
}
# Row controls over sets of periods, and quarter codes allowed per period.
CONTROLS = (
    Control("desarrollo_2025T1_T3", ("2025T1", "2025T2", "2025T3"), 40_361),
    Control("validacion_2025T4", ("2025T4",), 12_664),
    Control("reentrenamiento_2025", ("2025T1", "2025T2", "2025T3", "2025T4"), 53_025),
    Control("prueba_2026T1", ("2026T1",), 13_258),
)
ORIGINAL_QUARTERS = {"2025T1": (2,), "2025T2": (2, 3), "2025T3": (4,), "2025T4": (5,), "2026T1": (6,)}
TRAIN_PERIODS = ("2025T1", "2025T2", "2025T3")
VALIDATION_PERIODS = ("2025T4",)
TEST_PERIODS = ("2026T1",)
CLUSTER_FEATURES = ("edad", "antiguedad", "horas_semanales", "nivel_educativo_ordinal")

PROVENANCE = ("archivo_origen", "periodo_archivo", "anio_archivo", "trimestre_calendario", "fila_origen")

SPEC = PanelSpec(
    types=TYPES,
    keys=("NUM_HOGAR", "NUM_PERSONA"),
    rules=RULES,
    audited_codes=AUDITED_CODES,
    measures={
        "edad": "P02A03",
        "antiguedad": "P05C07A + P05C07B / 12.0D",
        "horas_semanales": "P05H01A",
        "salario_mensual": "P05D01",
    },
    categories=CATEGORIES,
    target="salario_mensual",
    predictors=("edad", "antiguedad", "horas_semanales"),
    labels=LABELS,
    violations=VIOLATIONS,
    period="periodo_archivo",
    record_id="id_registro",
    carried=(*PROVENANCE, "ANIO", "TRIMESTRE", "NUM_HOGAR", "NUM_PERSONA", "FACTOR"),
    code_columns={"P03A03A": "P03A03A", "P05C16": "P05C16", "codigo_dominio": "DOMINIO", "OCUPADOS": "OCUPADOS"},
)
