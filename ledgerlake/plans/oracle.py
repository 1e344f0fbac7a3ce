"""DuckDB twins of the binding views (``bindings.py``) for oracle SQL.

Each view is a CTE; ``with_views(names, body)`` emits the CTEs a query needs
(dependencies first) followed by the query body.  Only used to build the
``oracle_sql()`` strings that the driver runs in DuckDB.
"""

from __future__ import annotations

SETTLE_OFFSET = 1 << 52

_SECU_POS = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
             "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")

# ORDER BY for file position (p1..p10 and kind NULLS FIRST as Spark struct order).
POS_ORDER = "p_k, " + ", ".join(f"p{i} NULLS FIRST" for i in range(1, 11)) + ", kind NULLS FIRST"

BANK_COLS = ["account_number", "document_nr", "payment_date", "other_side_account",
             "other_side_name", "other_side_bank", "d_c", "payment_amount", "reference_number",
             "archival_number", "payment_description", "transaction_fee", "currency",
             "customer_id", "other_side_bic", "initiator", "transaction_reference",
             "provider_reference"]
SECU_COLS = ["value_date", "transaction_date", "type", "ticker", "description", "quantity",
             "price", "currency", "amount", "fee", "total_amount", "reference", "comment"]
BANK_KEYS = ["account_number", "document_nr", "payment_date", "other_side_account",
             "other_side_name", "other_side_bank", "d_c", "payment_description",
             "currency", "customer_id", "other_side_bic"]
SECU_KEYS = ["value_date", "transaction_date", "type", "ticker", "description", "currency"]


def _stmt(src: str, prefix: str, acct: str) -> str:
    return f"""
    SELECT '{prefix}' || strftime(m, '%Y%m') || '-' || CAST(r AS VARCHAR) AS id,
           '{acct}' AS account_type, 'BK' || CAST(r AS VARCHAR) AS bank,
           strftime(m, '%Y-%m-%d') AS from_date,
           strftime(m + INTERVAL 1 MONTH + INTERVAL 6 DAY, '%Y-%m-%d') AS to_date,
           CASE month(m) WHEN 11 THEN 'error' WHEN 12 THEN 'new' ELSE 'imported' END AS status,
           CAST((year(m) * 100 + month(m)) * 10 + r AS INTEGER) AS import_seq,
           m, r
    FROM (SELECT DISTINCT CAST(date_trunc('month', {src}) AS DATE) AS m, n_regionkey AS r FROM {'ox' if prefix == 'B' else 'lx'})"""


def _cover(ts: str) -> str:
    return (f"UNNEST(list_filter([CAST(date_trunc('month', {ts}) AS DATE), "
            f"CASE WHEN day({ts}) <= 7 THEN CAST(CAST(date_trunc('month', {ts}) AS DATE) - INTERVAL 1 MONTH AS DATE) END], "
            f"lambda x: x IS NOT NULL))")


def _avg_text(expr: str, scale_in: int = 8, scale_out: int = 12) -> str:
    """Exact AVG(DECIMAL(.., scale_in)) as text with scale_out decimals, HALF_UP.

    DuckDB's avg(decimal) returns DOUBLE; Spark returns an exact decimal.
    """
    q = f"(CAST(SUM({expr}) * {10 ** scale_in} AS HUGEINT) * {10 ** scale_out})"
    n = f"(CAST(COUNT({expr}) AS HUGEINT) * {10 ** scale_in})"
    a = f"((abs({q}) * 2 + {n}) // (2 * {n}))"
    frac = f" || '.' || lpad(CAST({a} % {10 ** scale_out} AS VARCHAR), {scale_out}, '0')" if scale_out else ""
    return (f"CASE WHEN COUNT({expr}) = 0 THEN NULL ELSE "
            f"(CASE WHEN {q} < 0 AND {a} > 0 THEN '-' ELSE '' END) || CAST({a} // {10 ** scale_out} AS VARCHAR)"
            f"{frac} END")


def _dec(c: str, p: int = 15, s: int = 2) -> str:
    """Text -> DECIMAL with blank = 0 (the library's ``to_decimal``)."""
    return f"(CASE WHEN trim({c}) = '' THEN CAST(0 AS DECIMAL({p},{s})) ELSE TRY_CAST(trim({c}) AS DECIMAL({p},{s})) END)"


VIEWS: dict[str, tuple[list[str], str]] = {
    "ox": ([], """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           c_custkey, c_name, c_nationkey, c_mktsegment, n_name, n_regionkey, r_name
    FROM orders JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey"""),
    "lx": ([], """
    SELECT l.*, p_name, p_brand, p_type, p_retailprice, n_regionkey
    FROM lineitem l JOIN part ON l_partkey = p_partkey
                    JOIN supplier ON l_suppkey = s_suppkey
                    JOIN nation ON s_nationkey = n_nationkey"""),
    "bank_stmt": (["ox"], _stmt("o_orderdate", "B", "bank")),
    "secu_stmt": (["lx"], _stmt("l_shipdate", "S", "secu")),
    "stmt": (["bank_stmt", "secu_stmt"], """
    SELECT id, account_type, bank, from_date, to_date, status, import_seq, id || '.csv' AS statement_file
    FROM (SELECT * FROM bank_stmt UNION ALL SELECT * FROM secu_stmt)"""),
    "bank_in": (["ox", "bank_stmt"], f"""
    SELECT s.id AS statement_id, o_orderkey AS p_k,
           NULL::INTEGER AS p1, NULL::BIGINT AS p2, NULL::BIGINT AS p3, NULL::DOUBLE AS p4,
           NULL::TIMESTAMP AS p5, NULL::DOUBLE AS p6, NULL::DOUBLE AS p7, NULL::DOUBLE AS p8,
           NULL::VARCHAR AS p9, NULL::VARCHAR AS p10, NULL::VARCHAR AS kind,
           printf('EE%02d7700', n_regionkey) AS account_number,
           substr(o_orderpriority, 1, 1) AS document_nr,
           strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS payment_date,
           printf('EE%02d1100', c_nationkey) AS other_side_account,
           c_name AS other_side_name,
           'BANK OF ' || r_name AS other_side_bank,
           CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'D' END AS d_c,
           CAST(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(15,2))
                     ELSE -CAST(o_totalprice AS DECIMAL(15,2)) END AS VARCHAR) AS payment_amount,
           'RF' || CAST(o_custkey AS VARCHAR) AS reference_number,
           'A' || CAST(o_orderkey AS VARCHAR) AS archival_number,
           c_mktsegment AS payment_description,
           CASE WHEN o_orderpriority = '1-URGENT' THEN '-1.50' ELSE '0.00' END AS transaction_fee,
           CASE WHEN n_regionkey = 1 THEN 'USD' ELSE 'EUR' END AS currency,
           CASE WHEN c_mktsegment = 'BUILDING' THEN printf('%08d', c_custkey)
                WHEN c_mktsegment = 'AUTOMOBILE' THEN printf('%011d', c_custkey) ELSE '' END AS customer_id,
           printf('BIC%02dXX', c_nationkey) AS other_side_bic,
           c_name AS initiator,
           'T' || CAST(o_orderkey AS VARCHAR) AS transaction_reference,
           CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'P' || CAST(o_orderkey AS VARCHAR) END AS provider_reference
    FROM (SELECT *, {_cover('o_orderdate')} AS cm FROM ox) x
    JOIN bank_stmt s ON s.m = x.cm AND s.r = x.n_regionkey"""),
    "secu_in": (["lx", "secu_stmt"], f"""
    SELECT statement_id, p_k, p1, p2, p3, p4, p5, p6, p7, p8, p9, p10, kind,
           value_date, transaction_date, typ AS type, ticker, description,
           CAST(CASE WHEN typ = 'split-' THEN -qty ELSE qty END AS VARCHAR) AS quantity,
           price, currency,
           CAST(amount AS VARCHAR) AS amount, CAST(fee AS VARCHAR) AS fee,
           CAST(CAST(amount + fee AS DECIMAL(15,2)) AS VARCHAR) AS total_amount,
           reference, comment
    FROM (
      SELECT s.id AS statement_id, l_orderkey AS p_k,
             {', '.join(f'{c} AS p{i}' for i, c in enumerate(_SECU_POS, 1))}, NULL::VARCHAR AS kind,
             CASE WHEN l_returnflag = 'A' THEN 'ost' WHEN l_returnflag = 'R' THEN 'müük'
                  WHEN l_linestatus = 'F' THEN 'split-' ELSE 'split+' END AS typ,
             strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS value_date,
             strftime(CAST(date_trunc('week', l_shipdate) AS DATE) - INTERVAL 2 DAY, '%Y-%m-%d') AS transaction_date,
             p_brand AS ticker, p_type AS description,
             CAST(l_quantity AS DECIMAL(15,2)) AS qty,
             CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS VARCHAR) AS price,
             CASE WHEN n_regionkey = 1 THEN 'USD' ELSE 'EUR' END AS currency,
             CAST(CASE WHEN l_returnflag = 'A' THEN -CAST(l_extendedprice AS DECIMAL(15,2))
                       WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(15,2))
                       ELSE CAST(0 AS DECIMAL(15,2)) END AS DECIMAL(15,2)) AS amount,
             CAST(CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DECIMAL(15,2))
                       ELSE 0 - round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(15,2)), 2)
                  END AS DECIMAL(15,2)) AS fee,
             'L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS reference,
             p_name AS comment
      FROM (SELECT *, {_cover('l_shipdate')} AS cm FROM lx) x
      JOIN secu_stmt s ON s.m = x.cm AND s.r = x.n_regionkey)"""),
    "settle_in": (["secu_in", "bank_stmt"], f"""
    SELECT b.id AS statement_id, s.p_k + {SETTLE_OFFSET} AS p_k,
           s.p1, s.p2, s.p3, s.p4, s.p5, s.p6, s.p7, s.p8, s.p9, s.p10, k.kind,
           printf('EE%02d7700', b.r) AS account_number,
           k.kind AS document_nr,
           s.value_date AS payment_date,
           'EE99BROKER' AS other_side_account,
           s.ticker AS other_side_name,
           'BROKERAGE' AS other_side_bank,
           CASE WHEN k.kind = 'S' AND s.type = 'müük' THEN 'C' ELSE 'D' END AS d_c,
           CASE WHEN k.kind = 'S' THEN s.amount ELSE s.fee END AS payment_amount,
           '' AS reference_number,
           'X' || s.reference AS archival_number,
           concat_ws(' ', CASE WHEN k.kind = 'S' THEN 'settle' ELSE 'fee' END, s.type, s.ticker, s.description) AS payment_description,
           '0.00' AS transaction_fee,
           s.currency,
           '' AS customer_id,
           'BROKEE2X' AS other_side_bic,
           '' AS initiator,
           s.reference AS transaction_reference,
           'S' || k.kind || s.reference AS provider_reference
    FROM secu_in s
    JOIN bank_stmt b ON b.id = 'B' || substr(s.statement_id, 2)
    CROSS JOIN (VALUES ('S'), ('F')) k(kind)
    WHERE s.type NOT LIKE 'split%'"""),
    "bank_all_in": (["bank_in", "settle_in"], """
    SELECT * FROM bank_in UNION ALL SELECT * FROM settle_in"""),
    "bank_raw": (["bank_in"], f"""
    SELECT statement_id, printf('%03d', row_number() OVER (PARTITION BY statement_id ORDER BY {POS_ORDER})) AS transaction_id,
           {', '.join(BANK_COLS)}
    FROM bank_in"""),
    "bank_all_raw": (["bank_all_in"], f"""
    SELECT statement_id, printf('%03d', row_number() OVER (PARTITION BY statement_id ORDER BY {POS_ORDER})) AS transaction_id,
           {', '.join(BANK_COLS)}
    FROM bank_all_in"""),
    "secu_raw": (["secu_in"], f"""
    SELECT statement_id, printf('%03d', row_number() OVER (PARTITION BY statement_id ORDER BY {POS_ORDER})) AS transaction_id,
           {', '.join(SECU_COLS)}
    FROM secu_in"""),
}


def _bank_total(src: str) -> tuple[list[str], str]:
    keys = ", ".join(BANK_KEYS)
    order = ", ".join(f"{k} NULLS FIRST" for k in ["payment_date", "d_c", "other_side_name"] +
                      [k for k in BANK_KEYS if k not in ("payment_date", "d_c", "other_side_name")])
    return ([src, "stmt"], f"""
    SELECT g.statement_id,
           printf('%s.%03d', 'STMT' || substr(st.from_date, 1, 4),
                  row_number() OVER (PARTITION BY g.statement_id ORDER BY {order})) AS statement_reference,
           {', '.join(f'coalesce({k}, {chr(39)}{chr(39)}) AS {k}' for k in BANK_KEYS)},
           coalesce(CAST(payment_amount AS VARCHAR), '') AS payment_amount,
           coalesce(CAST(transaction_fee AS VARCHAR), '') AS transaction_fee,
           coalesce(provider_reference, '') AS provider_reference,
           'new' AS status, 'system' AS created_by
    FROM (SELECT statement_id, {keys},
                 round(SUM({_dec('payment_amount')}), 2) AS payment_amount,
                 round(SUM({_dec('transaction_fee')}), 2) AS transaction_fee,
                 string_agg(provider_reference, ',' ORDER BY transaction_id) AS provider_reference
          FROM {src} GROUP BY statement_id, {keys}) g
    JOIN stmt st ON st.id = g.statement_id""")


def _secu_total(src: str) -> tuple[list[str], str]:
    keys = ", ".join(SECU_KEYS)
    order = ", ".join(f"{k} NULLS FIRST" for k in ["value_date", "type", "ticker", "transaction_date",
                                                   "description", "currency"])
    return ([src, "stmt"], f"""
    SELECT g.statement_id,
           printf('%s.%03d', 'STMT' || substr(st.from_date, 1, 4),
                  row_number() OVER (PARTITION BY g.statement_id ORDER BY {order})) AS statement_reference,
           {', '.join(f'coalesce({k}, {chr(39)}{chr(39)}) AS {k}' for k in SECU_KEYS)},
           coalesce(CAST(quantity AS VARCHAR), '') AS quantity,
           coalesce(price, '') AS price,
           coalesce(CAST(amount AS VARCHAR), '') AS amount,
           coalesce(CAST(fee AS VARCHAR), '') AS fee,
           coalesce(CAST(total_amount AS VARCHAR), '') AS total_amount,
           coalesce(reference, '') AS reference,
           'new' AS status, 'system' AS created_by
    FROM (SELECT statement_id, {keys},
                 SUM({_dec('quantity', 15, 6)}) AS quantity,
                 {_avg_text(_dec('price', 15, 8))} AS price,
                 SUM({_dec('amount')}) AS amount,
                 SUM({_dec('fee')}) AS fee,
                 SUM({_dec('total_amount')}) AS total_amount,
                 string_agg(reference, ',' ORDER BY transaction_id) AS reference
          FROM {src} GROUP BY statement_id, {keys}) g
    JOIN stmt st ON st.id = g.statement_id""")


def duck_id(*parts: str) -> str:
    """Twin of functions.ids.stable_id for non-NULL text parts."""
    joined = " || '|' || ".join(parts)
    h = f"sha256({joined})"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")


def _with_id(view: tuple[list[str], str]) -> tuple[list[str], str]:
    deps, body = view
    return deps, f"SELECT {duck_id('statement_id', 'statement_reference')} AS id, * FROM ({body})"


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, int):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


VIEWS["bank_total"] = _bank_total("bank_raw")
VIEWS["bank_all_total"] = _bank_total("bank_all_raw")
VIEWS["secu_total"] = _secu_total("secu_raw")
for _v in ("bank_total", "bank_all_total", "secu_total"):
    VIEWS[_v] = _with_id(VIEWS[_v])


def _config_views() -> None:
    from .bindings import CURRENCIES, LEDGER_OPS, TRX_TYPES
    VIEWS["trx_type"] = ([], _values(TRX_TYPES, ["id", "code", "statement_type", "flow_type", "asset_type",
                                                 "is_customer"]))
    VIEWS["ledger_op"] = ([], _values(LEDGER_OPS, ["id", "code", "name", "basis_trx_type", "included_words",
                                                   "excluded_words", "ordinal"]))
    VIEWS["currency"] = ([], _values([(c,) for c in CURRENCIES], ["code"]))


_config_views()
VIEWS["bank_dim"] = ([], """
    SELECT 'BK' || CAST(r_regionkey AS VARCHAR) AS id, printf('LEDG%02dEE', r_regionkey) AS swift_code_bic
    FROM region""")
VIEWS["customer_dim"] = ([], """
    SELECT 'C' || CAST(c_custkey AS VARCHAR) AS id, 'CR' || CAST(c_custkey AS VARCHAR) AS customer_ref,
           CASE WHEN c_mktsegment = 'BUILDING' THEN printf('%08d', c_custkey) END AS registration_number,
           CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN printf('%011d', c_custkey) END AS national_id,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name END AS org_name,
           CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name END AS ind_business_name,
           printf('EE%02d1100', c_nationkey) AS account_number
    FROM customer""")


def with_views(names: list[str], body: str) -> str:
    """``WITH`` the named views (and their dependencies, in order) + body."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        deps, _ = VIEWS[n]
        for d in deps:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}"


def dec(c: str, p: int = 15, s: int = 2) -> str:
    return _dec(c, p, s)


def avg_text(expr: str, scale_in: int = 8, scale_out: int = 12) -> str:
    return _avg_text(expr, scale_in, scale_out)
