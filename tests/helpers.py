"""Small loan frames and landing files for the tests."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

from sparklake.schemas import LOAN_COLUMNS, SILVER_SCHEMA

DAY = dt.date


def loan(**values):
    """A silver row with defaults; the calendar columns follow from ``periodo``."""
    row = {
        "periodo": "2024-01", "tipoCliente": "A", "actividad": "x", "entidad": "E1", "sector": "s",
        "moneda": "DOP", "provincia": "P1", "residencia": "r", "genero": "F", "persona": "N",
        "deudaCapital": 100.0, "deudaVencida": 10.0, "deudaVencidaDe31A90Dias": 1.0, "cantidadCredito": 2,
        "valorDesembolso": 50.0, "valorGarantia": 200.0, "valorProvisionCapitalYRendimiento": 5.0,
        "deuda": 110.0, "flg_periodo_invalido": 0, "flg_importe_negativo": 0, "dt_captura": DAY(2024, 2, 1),
    }
    row.update(values)
    if "periodo_date" not in row:
        row["periodo_date"] = dt.date.fromisoformat(row["periodo"] + "-01")
    day = row["periodo_date"]
    row["anio"], row["mes"] = (day.year, day.month) if day else (None, None)
    row["periodo_ym"] = day.year * 100 + day.month if day else None
    return row


def silver_frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in SILVER_SCHEMA.fieldNames()) for r in rows], SILVER_SCHEMA)


def landing_line(**values) -> dict:
    line = dict.fromkeys(LOAN_COLUMNS, "")
    line.update(
        periodo="2024-01", tipoCliente="A", entidad="E1", provincia="P1", genero="F", persona="N",
        deudaCapital="100.5", deudaVencida="10", deuda="110", cantidadCredito="2",
    )
    line.update(values)
    return line


def land(base: str, capture: str, lines: list[dict], encoding="utf-8", name="part.csv", columns=None):
    folder = Path(base) / f"dt={capture}"
    folder.mkdir(parents=True, exist_ok=True)
    columns = columns or LOAN_COLUMNS
    text = ",".join(columns) + "\n" + "".join(",".join(line.get(c, "") for c in columns) + "\n" for line in lines)
    (folder / name).write_bytes(text.encode(encoding))


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12)
    return a == b
