"""The demo change log: 17 changes that cover every case."""

from decimal import Decimal

SCHEMA = (
    "change_id long, operation string, order_id long, cust_first_name string, cust_last_name string, "
    "order_day string, order_month string, order_year string, unit_price decimal(12,2), "
    "quantity decimal(8,0), status_code string, country_code string, processed int"
)

_ROWS = """
1 I 1001 Ada Lovelace 05/01/2026 120.00 2 NW GB
2 I 1002 Alan Turing 11/02/2026 80.50 1 NW GB
3 I 1003 Grace Hopper 20/02/2026 49.99 3 NW US
4 I 1004 Katherine Johnson 01/03/2026 15.00 10 NW US
5 I 1005 Edsger Dijkstra 03/03/2026 200.00 1 NW DE
6 U 1001 Ada Lovelace 05/01/2026 120.00 2 SH GB
7 U 1003 Grace Hopper 20/02/2026 49.99 3 DL US
8 D 1004
9 I 2001 Bad Month 10/13/2026 10.00 1 NW US
10 I 2002 Bad Day XX/06/2026 10.00 1 NW US
11 U 2001 Now Valid 10/12/2026 10.00 1 SH US
12 U 2001 Still Blocked 11/12/2026 12.00 2 DL US
13 I 2001 Retry Insert 12/12/2026 15.00 1 NW US
14 I 2002 Retry Insert 07/06/2026 20.00 1 NW US
15 U 2002 Still Blocked 08/06/2026 22.00 3 SH US
16 D 2001
17 D 2002
"""

TARGET = {
    1001: ("Ada Lovelace", "2026-01-05", Decimal("240.00"), "SHIPPED", "EMEA"),
    1002: ("Alan Turing", "2026-02-11", Decimal("80.50"), "NEW", "EMEA"),
    1003: ("Grace Hopper", "2026-02-20", Decimal("149.97"), "DELIVERED", "AMERICAS"),
    1005: ("Edsger Dijkstra", "2026-03-03", Decimal("200.00"), "NEW", "EMEA"),
}


def order_row(change_id, op, order_id, first=None, last=None, date=None, price=None, quantity=None,
              status=None, country=None, processed=0):
    day, month, year = date.split("/") if date else (None, None, None)
    return (
        int(change_id), op, int(order_id), first, last, day, month, year,
        Decimal(price) if price else None, Decimal(quantity) if quantity else None,
        status, country, processed,
    )


def seed(spark):
    rows = [order_row(*line.split()) for line in _ROWS.strip().splitlines()]
    return spark.createDataFrame(rows, SCHEMA)


def good(spark, *rows):
    """Valid rows given as (change id, op, order id)."""
    data = [
        order_row(c, op, o, "A", "B", "01/02/2026", "10.00", "1", "NW", "US") for c, op, o in rows
    ]
    return spark.createDataFrame(data, SCHEMA)
