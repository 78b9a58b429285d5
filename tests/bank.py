"""A small bank with one of each planted anomaly."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as M

from estrato import model

AS_OF = dt.date(2026, 3, 10)
CUTOFF = dt.date(2026, 3, 10)

CLIENTS = [
    # id, name, surname, doc type, document, born, since, segment, score, city, dept, state, channel
    (1, "Rosa", "Vega", "cc", "10203040", dt.date(1990, 3, 11), dt.date(2025, 1, 5), "BASICO",
     700, "Pasto", "Nariño", "ACTIVO", "WEB"),
    (2, " Ivan ", "Luna", "CE", "123", dt.date(2004, 2, 29), dt.date(2025, 2, 5), "élite",
     None, "Tunja", "Boyaca", "ACTIVO", None),
    (3, "Ana", "Rios", "CC", "55667788", dt.date(1980, 6, 1), dt.date(2025, 3, 5), " ",
     610, "Pasto", "Putumayo", None, "APP"),
    (4, "Luz", "  ", "CC", "99887766", dt.date(1985, 6, 1), dt.date(2025, 3, 5), "PREMIUM",
     610, "Tunja", "Boyaca", "ACTIVO", "APP"),
    (5, "Leo", "Mar", "CC", "44332211", dt.date(2030, 1, 1), dt.date(2025, 3, 5), None,
     610, "Tunja", "Boyaca", "ACTIVO", "APP"),
]
PRODUCTS = [
    ("P1", "Libre", "CREDITO_LIBRE", M("24.0000"), 24, M("100.00"), M("5.00"), "ACTIVO"),
    ("P2", "Ahorro", "cuenta_ahorros", None, 12, None, None, None),
    ("P3", " ", "PSE", M("10.0000"), 12, M("1.00"), None, "ACTIVO"),
]
BRANCHES = [
    ("S1", "Centro", "OFICINA", "Pasto", "Nariño", None, M("-77.1"), 1),
    ("S2", "Norte", None, None, None, M("5.5"), M("-73.3"), None),
]


def _obligation(i, cli, prod, balance, days, start, due, grade="A"):
    value = None if balance is None else M(balance)
    return (i, cli, prod, value, value, value, M("10.00"), start, due, days, 5, grade)


_START, _DUE = dt.date(2025, 6, 15), dt.date(2026, 1, 10)
OBLIGATIONS = [
    _obligation(1, 1, "P1", "1200.00", 0, _START, _DUE),
    _obligation(2, 1, "P1", "1000.05", 31, _START, _DUE, None),
    _obligation(3, 2, "P1", "500.00", -1, _START, _DUE),
    _obligation(4, 2, "P2", "800.00", 91, _START, _DUE),
    _obligation(5, 3, "P1", "100.00", 10, _DUE, _START),  # due before start
    _obligation(6, 4, "P1", "100.00", 10, _START, _DUE),  # rejected client
    _obligation(7, 3, "P3", "100.00", 10, _START, _DUE),  # rejected product
    _obligation(8, 3, "P1", None, None, _START, None),  # no due date
]


def _movement(i, cli, day, clock, value, channel="APP", city="Tunja", prod="P1"):
    return (i, cli, prod, f"C{cli}", day, clock, M(value), "PAGO", channel, city, "APROBADO",
            None if i == 2 else "D1")


_D = dt.date(2026, 3, 1)
MOVEMENTS = [
    _movement(1, 1, _D, "10:00:00", "100.00"),
    _movement(2, 1, _D, "10:00:00", "100.00"),
    _movement(3, 1, dt.date(2026, 3, 2), "09:00:00", "100.00", channel="Atm"),
    _movement(4, 1, dt.date(2026, 3, 3), "02:35:00", "100.01", channel="corresponsal"),
    _movement(5, 1, dt.date(2026, 3, 3), "05:00:00", "100.00"),
    _movement(6, 2, _D, "00:00:00", "7.50", city="Pasto"),  # city in two departments
    _movement(7, 2, _D, "00:00:01", "7.50", city="Lima"),  # unknown city
    _movement(8, 4, _D, "10:00:00", "9.00"),  # rejected client
]
FEES = [
    (1, 1, "P1", dt.date(2026, 1, 31), M("10.00"), "MANEJO", "cobrada"),
    (2, 1, "P1", dt.date(2026, 1, 1), M("2.50"), None, "COBRADA"),
    (3, 1, "P1", dt.date(2025, 3, 31), M("99.00"), "MANEJO", "COBRADA"),  # before the window
    (4, 2, "P1", dt.date(2026, 2, 1), M("7.00"), "MANEJO", "PENDIENTE"),
    (5, 2, "P1", dt.date(2026, 2, 1), M("-1.00"), "MANEJO", "COBRADA"),
]
INCENTIVES = [
    (1, 1, "P1", dt.date(2026, 3, 31), "BONO", M("3.00"), "OTORGADO"),
    (2, 2, "P1", dt.date(2026, 3, 1), "BONO", M("4.00"), "CANCELADO"),
]

ROWS = {
    model.CLIENTS: CLIENTS,
    model.PRODUCTS: PRODUCTS,
    model.BRANCHES: BRANCHES,
    model.OBLIGATIONS: OBLIGATIONS,
    model.MOVEMENTS: MOVEMENTS,
    model.FEES: FEES,
    model.INCENTIVES: INCENTIVES,
}


def landing(spark):
    return {t.name: spark.createDataFrame(rows, t.schema) for t, rows in ROWS.items()}
