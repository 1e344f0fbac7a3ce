"""Statement world derived from the driver's TPC-H-like tables.

Everything is computed by Spark from the given parquet tables, so the work
grows with them:

* ``stmt``    one bank statement per (order month, customer region) and one
              securities statement per (ship month, supplier region); a
              statement covers its month plus the first 7 days of the next, so
              neighbouring statements overlap and share rows (real duplicates).
* ``bank_in`` one mapped bank row per (order, covering statement).
* ``secu_in`` one mapped securities row per (line item, covering statement).
* ``settle_in`` bank settlement rows (payment + fee) for the securities
              trades, booked on the bank statement of the same region/month,
              so that recognition has payments to find.
* dimension tables for recognition: bank, customer, trx_type, ledger_op_type,
  currency.

The DuckDB twin of every view lives in ``oracle.py``; keep them in step.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..formats import BANK_COLUMNS, SECU_COLUMNS
from ..session import slices_of, written

DEC2 = DecimalType(15, 2)

#: Most months of a slice that are compared with one by one.
MAX_NAMED = 64


# Fact tables are always dealt, since their files need not be split well: by the key of their first
# join, so that it needs no shuffle of its own.
FACT_KEYS = {"lineitem": "l_partkey", "orders": "o_custkey"}
FACT_DATES = {"lineitem": "l_shipdate", "orders": "o_orderdate"}


def _fmt_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _month_start(ts: Column) -> Column:
    return F.to_date(F.date_trunc("month", ts))


def _next_month(m: date) -> date:
    return (m.replace(day=28) + timedelta(4)).replace(day=1)


def _statements(keys: DataFrame, prefix: str, account_type: str) -> DataFrame:
    """keys: distinct (m date, r int) with the number of rows dated in the month -> control rows."""
    m = F.col("m")
    return keys.select(
        F.concat(F.lit(prefix), F.date_format(m, "yyyyMM"), F.lit("-"), F.col("r").cast("string")).alias("id"),
        F.lit(account_type).alias("account_type"),
        F.concat(F.lit("BK"), F.col("r").cast("string")).alias("bank"),
        _fmt_date(m).alias("from_date"),
        _fmt_date(F.date_add(F.add_months(m, 1), 6)).alias("to_date"),
        F.when(F.month(m) == 11, "error").when(F.month(m) == 12, "new").otherwise("imported").alias("status"),
        ((F.year(m) * 100 + F.month(m)) * 10 + F.col("r")).cast("int").alias("import_seq"),
        m.alias("m"), F.col("r"), F.col("month_rows"),
    )


def _covering_months(ts: Column) -> Column:
    """Months whose statement covers ``ts``: its own, plus the previous one in the first 7 days."""
    own = _month_start(ts)
    return F.filter(F.array(own, F.when(F.dayofmonth(ts) <= 7, F.add_months(own, -1))),
                    lambda x: x.isNotNull())


@dataclass
class World:
    spark: SparkSession
    sf_dir: str
    slice: tuple[int, int] = (0, 1)     # (i, n): the months of every n-th statement month
    months: tuple = ()                  # a slice's months, where they are few enough to be named

    def t(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in FACT_KEYS:
            return df
        return (df.filter(self._covered(F.col(FACT_DATES[name]))) if self.slice[1] > 1 else df).repartition(FACT_KEYS[name])

    def _covered(self, at: Column) -> Column:
        """Dates that a statement of the slice covers.  Every slice reads every date, so they are compared with
        the days on which the months' statements begin and end instead of being taken apart."""
        if self.months:
            return reduce(Column.__or__, [(at >= F.lit(m)) & (at < F.lit(_next_month(m) + timedelta(7))) for m in self.months])
        own = _month_start(at)
        return self._in_slice(own) | ((F.dayofmonth(at) <= 7) & self._in_slice(F.add_months(own, -1)))

    def _in_slice(self, m: Column) -> Column:
        i, n = self.slice
        return F.pmod(F.year(m) * 12 + F.month(m), F.lit(n)) == i

    # -- orders side -------------------------------------------------------
    @cached_property
    def _orders_x(self) -> DataFrame:
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                    "o_orderdate", "o_orderpriority")
        c = self.t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        n = self.t("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.t("region").select("r_regionkey", "r_name")
        return (o.join(c, o.o_custkey == c.c_custkey)
                .join(n, F.col("c_nationkey") == n.n_nationkey)
                .join(r, F.col("n_regionkey") == r.r_regionkey))

    @cached_property
    def _lines_x(self) -> DataFrame:
        li = self.t("lineitem")
        p = self.t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
        s = self.t("supplier").select("s_suppkey", "s_nationkey")
        n = self.t("nation").select("n_nationkey", "n_regionkey")
        return (li.join(p, li.l_partkey == p.p_partkey)
                .join(s, li.l_suppkey == s.s_suppkey)
                .join(n, F.col("s_nationkey") == n.n_nationkey))

    # -- statements --------------------------------------------------------
    @cached_property
    def bank_stmt(self) -> DataFrame:
        n = self.t("nation").select("n_nationkey", "n_regionkey")
        c = self.t("customer").select("c_custkey", "c_nationkey").join(n, F.col("c_nationkey") == n.n_nationkey)
        o = self.t("orders").groupBy("o_custkey", _month_start(F.col("o_orderdate")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
        keys = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("m", F.col("n_regionkey").alias("r"))
                .agg(F.sum("n").alias("month_rows")))
        return written(_statements(keys, "B", "bank"))

    @cached_property
    def secu_stmt(self) -> DataFrame:
        n = self.t("nation").select("n_nationkey", "n_regionkey")
        s = self.t("supplier").select("s_suppkey", "s_nationkey").join(n, F.col("s_nationkey") == n.n_nationkey)
        li = self.t("lineitem").groupBy("l_suppkey", _month_start(F.col("l_shipdate")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
        keys = (li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("m", F.col("n_regionkey").alias("r"))
                .agg(F.sum("n").alias("month_rows")))
        return written(_statements(keys, "S", "secu"))

    def most_rows(self, kind: str, settlements: bool = False) -> int:
        """A bound on the rows of one statement: it covers its month and some days of the next, and
        every securities row settles in two bank rows."""
        st = self.bank_stmt if kind == "bank" else self.secu_stmt
        own = 2 * (st.agg(F.max("month_rows")).first()[0] or 0)
        return own + 2 * self.most_rows("secu") if settlements else own

    @cached_property
    def stmt(self) -> DataFrame:
        """The statement control table (one row per statement: small, kept as
        a written table so every query does not re-derive it)."""
        cols = ["id", "account_type", "bank", "from_date", "to_date", "status", "import_seq"]
        return (self.bank_stmt.select(*cols).unionByName(self.secu_stmt.select(*cols))
                .withColumn("statement_file", F.concat(F.col("id"), F.lit(".csv"))))

    # -- raw rows ----------------------------------------------------------
    def _in_months(self, x: DataFrame, at: str) -> DataFrame:
        x = x.withColumn("m", F.explode(_covering_months(F.col(at))))
        return x.filter(self._in_slice(F.col("m"))) if self.slice[1] > 1 else x

    @cached_property
    def bank_at(self) -> DataFrame:
        """Orders, once per statement that covers them."""
        x = self._in_months(self._orders_x, "o_orderdate")
        st = self.bank_stmt.select(F.col("id").alias("statement_id"), "m", "r")
        return x.join(st, (x.m == st.m) & (x.n_regionkey == st.r)).drop("m", "r")

    @cached_property
    def secu_at(self) -> DataFrame:
        """Line items, once per statement that covers them."""
        x = self._in_months(self._lines_x, "l_shipdate")
        st = self.secu_stmt.select(F.col("id").alias("statement_id"), "m", "r")
        return x.join(st, (x.m == st.m) & (x.n_regionkey == st.r)).select(
            "statement_id", *SECU_ORDER, "n_regionkey", "p_brand", "p_type", "p_retailprice", "p_name")

    def slices(self, bank: bool = True, size: int = 1) -> list["World"]:
        """Worlds of the statements of some months each, all together.  A securities statement is in the slice
        of the bank statement that its trades settle on.  A slice reads its rows from the given tables, so
        that no copy of all rows is kept.  Without ``bank`` only securities statements count; ``size``: how
        many times the usual rows a slice may have."""
        tables = (self.bank_stmt, self.secu_stmt) if bank else (self.secu_stmt,)
        found = [st.agg(F.sum("month_rows"), F.min("m"), F.max("m")).first() for st in tables]
        n = slices_of(sum(2 * (rows or 0) for rows, _, _ in found) // size)
        if n == 1:
            return [self]
        first, last = (of((m for _, *ends in found for m in ends if m is not None), default=None) for of in (min, max))
        months = []
        if first is not None:
            months.append((first - timedelta(1)).replace(day=1))
            while months[-1] < last:
                months.append(_next_month(months[-1]))
        out = []
        for i in range(n):
            own = tuple(m for m in months if (m.year * 12 + m.month) % n == i)
            out.append(World(self.spark, self.sf_dir, (i, n), own if len(own) <= MAX_NAMED else ()))
        for w in out:
            w.secu_stmt = self.secu_stmt
            if bank:
                w.bank_stmt = self.bank_stmt
        return out

    def store(self, *tables: str) -> None:
        """Write the rows of a slice (bank_at, secu_at), which are read several times."""
        if self.slice[1] > 1:
            for name in tables:
                setattr(self, name, written(getattr(self, name)))

    @cached_property
    def bank_in(self) -> DataFrame:
        """Mapped bank rows (text), ``pos_key`` = file order inside the statement."""
        x = self.bank_at
        d_c = F.when(F.col("o_orderstatus") == "F", "C").otherwise("D")
        amt = F.col("o_totalprice").cast(DEC2)
        vals = {
            "account_number": F.format_string("EE%02d7700", F.col("n_regionkey")),
            "document_nr": F.substring("o_orderpriority", 1, 1),
            "payment_date": _fmt_date(F.date_trunc("week", F.col("o_orderdate"))),
            "other_side_account": F.format_string("EE%02d1100", F.col("c_nationkey")),
            "other_side_name": F.col("c_name"),
            "other_side_bank": F.concat(F.lit("BANK OF "), F.col("r_name")),
            "d_c": d_c,
            "payment_amount": F.when(d_c == "C", amt).otherwise(-amt).cast("string"),
            "reference_number": F.concat(F.lit("RF"), F.col("o_custkey").cast("string")),
            "archival_number": F.concat(F.lit("A"), F.col("o_orderkey").cast("string")),
            "payment_description": F.col("c_mktsegment"),
            "transaction_fee": F.when(F.col("o_orderpriority") == "1-URGENT", "-1.50").otherwise("0.00"),
            "currency": F.when(F.col("n_regionkey") == 1, "USD").otherwise("EUR"),
            "customer_id": (F.when(F.col("c_mktsegment") == "BUILDING", F.format_string("%08d", F.col("c_custkey")))
                            .when(F.col("c_mktsegment") == "AUTOMOBILE", F.format_string("%011d", F.col("c_custkey")))
                            .otherwise("")),
            "other_side_bic": F.format_string("BIC%02dXX", F.col("c_nationkey")),
            "initiator": F.col("c_name"),
            "transaction_reference": F.concat(F.lit("T"), F.col("o_orderkey").cast("string")),
            "provider_reference": F.when(F.col("o_orderpriority") == "5-LOW", "")
                                   .otherwise(F.concat(F.lit("P"), F.col("o_orderkey").cast("string"))),
        }
        null_tail = [F.lit(None).cast(t) for t in SECU_ORDER_TYPES[1:]]
        pos = _pos(F.col("o_orderkey"), null_tail, F.lit(None).cast("string"))
        return x.select(F.col("statement_id"), pos.alias("pos"), *[vals[c].alias(c) for c in BANK_COLUMNS])

    @cached_property
    def secu_in(self) -> DataFrame:
        """Mapped securities rows; ``pos_key`` = struct giving file order."""
        x = self.secu_at
        typ = (F.when(F.col("l_returnflag") == "A", "ost").when(F.col("l_returnflag") == "R", "müük")
               .when(F.col("l_linestatus") == "F", "split-").otherwise("split+"))
        ext = F.col("l_extendedprice").cast(DEC2)
        qty = F.col("l_quantity").cast(DEC2)
        amount = (F.when(typ == "ost", -ext).when(typ == "müük", ext)
                  .otherwise(F.lit(0).cast(DEC2))).cast(DEC2)
        fee = F.when(typ.startswith("split"), F.lit(0).cast(DEC2)).otherwise(
            (F.lit(0) - F.round(ext * F.col("l_tax").cast(DEC2), 2)).cast(DEC2))
        week = F.date_trunc("week", F.col("l_shipdate"))
        vals = {
            "value_date": _fmt_date(week),
            "transaction_date": _fmt_date(F.date_sub(F.to_date(week), 2)),
            "type": typ,
            "ticker": F.col("p_brand"),
            "description": F.col("p_type"),
            "quantity": F.when(typ == "split-", -qty).otherwise(qty).cast("string"),
            "price": F.col("p_retailprice").cast(DEC2).cast("string"),
            "currency": F.when(F.col("n_regionkey") == 1, "USD").otherwise("EUR"),
            "amount": amount.cast("string"),
            "fee": fee.cast("string"),
            "total_amount": (amount + fee).cast(DEC2).cast("string"),
            "reference": F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"),
                                  F.col("l_linenumber").cast("string")),
            "comment": F.col("p_name"),
        }
        pos = _pos(F.col("l_orderkey"), [F.col(c) for c in SECU_ORDER[1:]], F.lit(None).cast("string"))
        return x.select(F.col("statement_id"), pos.alias("pos"), *[vals[c].alias(c) for c in SECU_COLUMNS])

    @cached_property
    def settle_in(self) -> DataFrame:
        """Bank rows settling each buy/sell: a payment line and a fee line.

        Booked on the bank statement of the same month and region as the
        securities statement; amounts carry the securities signs.
        """
        s = self.secu_in.filter(~F.col("type").startswith("split"))
        s = s.withColumn("statement_id", F.concat(F.lit("B"), F.substring("statement_id", 2, 100)))
        s = s.join(self.bank_stmt.select(F.col("id").alias("statement_id"), "r"), "statement_id")
        kinds = F.explode(F.array(F.lit("S"), F.lit("F"))).alias("kind")
        s = s.select("*", kinds)
        main = F.col("kind") == "S"
        amt = F.when(main, F.col("amount")).otherwise(F.col("fee"))
        vals = {
            "account_number": F.format_string("EE%02d7700", F.col("r")),
            "document_nr": F.col("kind"),
            "payment_date": F.col("value_date"),
            "other_side_account": F.lit("EE99BROKER"),
            "other_side_name": F.col("ticker"),
            "other_side_bank": F.lit("BROKERAGE"),
            "d_c": F.when(main & (F.col("type") == "müük"), "C").otherwise("D"),
            "payment_amount": amt,
            "reference_number": F.lit(""),
            "archival_number": F.concat(F.lit("X"), F.col("reference")),
            "payment_description": F.concat_ws(" ", F.when(main, "settle").otherwise("fee"),
                                               F.col("type"), F.col("ticker"), F.col("description")),
            "transaction_fee": F.lit("0.00"),
            "currency": F.col("currency"),
            "customer_id": F.lit(""),
            "other_side_bic": F.lit("BROKEE2X"),
            "initiator": F.lit(""),
            "transaction_reference": F.col("reference"),
            "provider_reference": F.concat(F.lit("S"), F.col("kind"), F.col("reference")),
        }
        p = F.col("pos")
        pos = _pos(p["k"] + F.lit(SETTLE_OFFSET), [p[f"p{i}"] for i in range(1, len(SECU_ORDER))],
                   F.col("kind"))
        return s.select(F.col("statement_id"), pos.alias("pos"), *[vals[c].alias(c) for c in BANK_COLUMNS])

    @cached_property
    def bank_all_in(self) -> DataFrame:
        """Customer payments plus securities settlements."""
        return self.bank_in.unionByName(self.settle_in)

    # -- reference data for recognition -------------------------------------
    @cached_property
    def bank_dim(self) -> DataFrame:
        r = self.t("region")
        return r.select(F.concat(F.lit("BK"), F.col("r_regionkey").cast("string")).alias("id"),
                        F.format_string("LEDG%02dEE", F.col("r_regionkey")).alias("swift_code_bic"))

    @cached_property
    def customer_dim(self) -> DataFrame:
        c = self.t("customer")
        legal = F.col("c_mktsegment") == "BUILDING"
        person = F.col("c_mktsegment") == "AUTOMOBILE"
        return c.select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
            F.concat(F.lit("CR"), F.col("c_custkey").cast("string")).alias("customer_ref"),
            F.when(legal, F.format_string("%08d", F.col("c_custkey"))).alias("registration_number"),
            F.when(person, F.format_string("%011d", F.col("c_custkey"))).alias("national_id"),
            F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_name")).alias("org_name"),
            F.when(F.col("c_mktsegment") == "FURNITURE", F.col("c_name")).alias("ind_business_name"),
            F.format_string("EE%02d1100", F.col("c_nationkey")).alias("account_number"),
        )


# Reference data for recognition (fixed configuration rows, invented codes).
TRX_TYPES = [
    # id, code, statement_type, flow_type, asset_type, is_customer
    ("TT1", "SECBUY", "secu", "out", "SCR01", None),
    ("TT2", "SECSELL", "secu", "in", "SCR01", None),
    ("TT3", "SL", "secu", None, "SCR01", None),
    ("TT4", "CUSTIN", "bank", "in", "CSH01", "yes"),
    ("TT5", "CUSTOUT", "bank", "out", "CSH01", "yes"),
    ("TT6", "BANKIN", "bank", "in", "CSH01", "no"),
]
LEDGER_OPS = [
    # id, code, name, basis_trx_type, included_words, excluded_words, ordinal
    ("LO1", "BUY-ECO", "economy buys", "SECBUY", "economy", "", 1),
    ("LO2", "BUY-OTHER", "other buys", "SECBUY", "", "economy", 2),
    ("LO3", "SELL-ANY", "sales", "SECSELL", "", "", 3),
    ("LO4", "IN-BUILD", "building receipts", "CUSTIN", "building", "", 4),
    ("LO5", "IN-MACH", "machinery and furniture", "CUSTIN", "machinery, furniture", "household", 5),
    ("LO6", "OUT-ANY", "customer payments", "CUSTOUT", None, None, 6),
    ("LO7", "SPLIT", "splits", "SL", "", "", 7),
]
CURRENCIES = ["EUR", "USD"]

# Securities file order: these columns, ascending (ties = identical rows).
SECU_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
              "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
SECU_ORDER_TYPES = ["bigint", "int", "bigint", "bigint", "double", "timestamp", "double",
                    "double", "double", "string", "string"]
# Settlement rows sort after all customer payments of a bank statement.
SETTLE_OFFSET = 1 << 52
# Rows per numbering bucket (see operators.numbering): buckets follow pos.k.
POS_BUCKET_ROWS = 1 << 16


def _pos(k: Column, tail: list, kind: Column) -> Column:
    """File-order key: struct(k, p1..p10, kind), compared field by field."""
    fields = [k.cast("bigint").alias("k")]
    fields += [c.cast(t).alias(f"p{i}") for i, (c, t) in enumerate(zip(tail, SECU_ORDER_TYPES[1:]), 1)]
    fields.append(kind.alias("kind"))
    return F.struct(*fields)


def pos_bucket() -> Column:
    """Numbering bucket, non-decreasing along ``pos``."""
    return F.expr(f"pos.k div {POS_BUCKET_ROWS}")


def _config(spark: SparkSession):
    trx = spark.createDataFrame(TRX_TYPES, "id string, code string, statement_type string, flow_type string, "
                                           "asset_type string, is_customer string")
    ops = spark.createDataFrame(LEDGER_OPS, "id string, code string, name string, basis_trx_type string, "
                                            "included_words string, excluded_words string, ordinal int")
    cur = spark.createDataFrame([(c,) for c in CURRENCIES], "code string")
    return trx, ops, cur


World.trx_type = cached_property(lambda self: _config(self.spark)[0])
World.ledger_op = cached_property(lambda self: _config(self.spark)[1])
World.currency = cached_property(lambda self: _config(self.spark)[2])
for _n in ("trx_type", "ledger_op", "currency"):
    getattr(World, _n).__set_name__(World, _n)


def world(spark: SparkSession, sf_dir: str) -> World:
    return World(spark, sf_dir)
