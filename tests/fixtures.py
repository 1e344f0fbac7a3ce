"""Synthetic statement CSVs shaped like the reference's layouts (made-up data)."""

from __future__ import annotations

import os

from ledgerlake.formats import LHV_HEADER, SECURITIES_HEADER, SWEDBANK_HEADER

BOM = "\ufeff"


def q(v: str) -> str:
    return '"' + v.replace('"', '""') + '"'


def lhv_row(account="EE000000000000000001", doc="1", date="2024-01-05", other_acc="EE99",
            name="ACME OU", bank_code="", dc="D", amount="-10.00", ref="", arch="AR1",
            desc="payment", fee="0.00", cur="EUR", cust="", bic="HABAEE2X", init="",
            trx_ref="", provider="PR1") -> list[str]:
    # 19 raw cells: cell 6 is the blank column the parser drops
    return [account, doc, date, other_acc, name, bank_code, "", dc, amount, ref, arch, desc,
            fee, cur, cust, bic, init, trx_ref, provider]


def secu_row(value_date="2024-01-10", trade_date="2024-01-08", typ="ost", ticker="LHV1T",
             desc="LHV Group", qty="257", price="3.50", cur="EUR", amount="-899.50",
             fee="-2.00", total="-901.50", ref="REF1", comment="") -> list[str]:
    return [value_date, trade_date, typ, ticker, desc, qty, price, cur, amount, fee, total, ref, comment]


def swed_row(**kw) -> list[str]:
    r = lhv_row(**kw)
    return r[:6] + r[7:15]


def csv_text(header: list[str], rows: list[list[str]], sep=",", bom=True, quote=True,
             eol="\r\n") -> str:
    fmt = q if quote else (lambda v: v)
    lines = [sep.join(fmt(h) for h in header)] + [sep.join(fmt(v) for v in r) for r in rows]
    return (BOM if bom else "") + eol.join(lines) + eol


def write(dirpath: str, name: str, text: str) -> str:
    os.makedirs(dirpath, exist_ok=True)
    p = os.path.join(dirpath, name)
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return p


def lhv_csv(rows, **kw) -> str:
    return csv_text(LHV_HEADER, rows, ",", **kw)


def secu_csv(rows, **kw) -> str:
    return csv_text(SECURITIES_HEADER, rows, ",", **kw)


def swed_csv(rows, **kw) -> str:
    return csv_text(SWEDBANK_HEADER, rows, ";", **kw)
