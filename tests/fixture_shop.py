"""A tiny shop with every edge case of the warehouse rules."""

from datetime import datetime as D
from decimal import Decimal as M

from martlet.schemas import STAGING


def _orders():
    def row(oid, customer, status, bought, arrived, due):
        return (oid, customer, status, bought, None, None, arrived, due)

    due = D(2017, 3, 10)
    return [
        row("o01", "c1", "delivered", D(2017, 3, 1, 12), D(2017, 3, 10, 10), due),  # 10 h late
        row("o02", "c1", "delivered", D(2017, 3, 1, 12), D(2017, 3, 9, 23), due),  # 1 h early
        row("o03", "c2", "delivered", D(2017, 3, 1, 12), due, due),  # exactly on time
        row("o04", "c2", "delivered", D(2017, 3, 1, 12), D(2017, 3, 11), due),  # 24 h late
        row("o05", "c2", "delivered", D(2017, 3, 1, 12), None, due),  # no delivery date
        row("o06", "c9", "shipped", D(2016, 2, 29, 5), None, None),  # customer unknown, no estimate
        row("o07", "c3", "canceled", D(2019, 7, 1), None, due),  # outside the calendar
        row("o08", "c3", "delivered", D(2016, 12, 25, 1), D(2016, 12, 30), D(2017, 1, 5)),
        row("o09", "c1", "unavailable", D(2017, 12, 25), None, None),  # has no lines
    ]


def _items():
    def row(oid, n, product, seller, price, freight):
        return (oid, n, product, seller, D(2017, 1, 1), M(price), M(freight))

    return [
        row("o01", 1, "p1", "s1", "10.00", "1.00"), row("o01", 2, "p2", "s1", "20.00", "2.50"),
        row("o02", 1, "p9", "s1", "30.00", "3.00"), row("o03", 1, "p3", "s9", "40.00", "0.00"),
        row("o04", 1, "p4", "s2", "50.00", "5.00"), row("o05", 1, "p5", "s2", "60.00", "6.00"),
        row("o06", 1, "p1", "s1", "70.00", "7.00"), row("o07", 1, "p1", "s1", "80.00", "8.00"),
        row("o08", 1, "p2", "s2", "90.00", "9.00"),
        row("o99", 1, "p1", "s1", "99.00", "9.00"),  # no such order
    ]


def _payments():
    return [
        ("o01", 2, "voucher", 1, M("5.00")), ("o01", 1, "credit_card", 3, M("28.50")),
        ("o02", 1, None, 1, M("33.00")), ("o03", 1, " boleto", 1, M("20.00")),
        ("o03", 2, "boleto", 1, M("20.00")), ("o04", 1, "", 1, M("55.00")),
        ("o05", 1, "debit_card", 2, M("66.00")), ("o07", 1, "boleto ", 1, M("88.00")),
    ]  # o06 and o08 have none


def _reviews():
    def row(rid, oid, score):
        return (rid, oid, score, None, None, None, None)

    return [row("r1", "o01", 3), row("r2", "o01", 3), row("r3", "o01", 4), row("r4", "o02", 1),
            row("r5", "o03", 5)]


def staging(spark):
    rows = {
        "customers": [
            ("c1", "u1", 1001, "\tSao Paulo ", "sp"), ("c2", "u1", 2002, " Manaus", " AM "),
            ("c3", "u3", 9999, "nowhere", "ZZ"),
        ],
        "orders": _orders(),
        "order_items": _items(),
        "payments": _payments(),
        "reviews": _reviews(),
        "products": [
            ("p1", "moveis", 1, 1, 1, 499.0, 1.0, 1.0, 1.0), ("p2", "pc_gamer", 1, 1, 1, 500.0, 1.0, 1.0, 1.0),
            ("p3", "sem_traducao", 1, 1, 1, 1999.0, 1.0, 1.0, 1.0), ("p4", "duplo", 1, 1, 1, 2000.0, 1.0, 1.0, 1.0),
            ("p5", None, None, None, None, None, None, None, None),
        ],
        "sellers": [("s1", 1001, "Rio ", "rj"), ("s2", 2002, "X", "PR")],
        "geolocation": [
            (1001, -10.0, 20.0, "alpha", "SP"), (1001, -20.0, 40.0, "zeta", "AM"),  # maxima from two rows
            (2002, 1.0, 2.0, "manaus", "AM"),
        ],
        "category_translation": [("moveis", "furniture"), ("duplo", "double_a"), ("duplo", "double_b")],
        "holidays": [(D(2016, 12, 25).date(), "Natal", "Christmas", "BR"),
                     (D(2016, 12, 25).date(), "Outro", "Another", "BR"),
                     (D(2016, 1, 1).date(), "Ano Novo", "New Year's Day", "BR")],
    }
    return {n: spark.createDataFrame(r, STAGING[n]) for n, r in rows.items()}
