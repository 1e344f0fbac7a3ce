"""Consolidation: raw rows -> summary rows per statement.

One lazy plan: an aggregate keyed by (statement_id, keys) with ordered reference
lists (``functions.ordered_text``), then per-statement numbering
(``number_by_keys``) for the statement references.

Lists of large groups (G5, S3) are built in ranges of the list's order: a row's
range follows from cuts sampled within its group (``with_parts``), each range is
sorted and joined by its own task, and only the finished pieces meet, with the
sums of their ranges; groups without a cut take one aggregate.  Where the caller knows that no statement has more than
``PART_ROWS`` rows, no group can be large and one aggregate does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..formats import SYSTEM_USER, TOTAL_DEFAULT_STATUS
from ..functions import (empty_if_null, ordered_text, stable_id, statement_ref, statement_ref_prefix,
                         to_decimal)
from ..functions.numbers import exact_ratio_text
from ..session import written
from .numbering import PART_ROWS, number_by_keys, part_cuts, same_keys, with_parts

# Group keys and output order, as the reference's GROUP BY / ORDER BY (fixed values).
BANK_KEYS = ["account_number", "document_nr", "payment_date", "other_side_account",
             "other_side_name", "other_side_bank", "d_c", "payment_description",
             "currency", "customer_id", "other_side_bic"]
BANK_SORT = ["payment_date", "d_c", "other_side_name"]
SECU_KEYS = ["value_date", "transaction_date", "type", "ticker", "description", "currency"]
SECU_SORT = ["value_date", "type", "ticker"]

# Column order of the summary tables (reference INSERT lists, prefix dropped).
BANK_TOTAL_COLUMNS = ["id", "statement_id", "statement_reference", "account_number",
                      "document_nr", "payment_date", "other_side_account", "other_side_name",
                      "other_side_bank", "d_c", "payment_description", "currency",
                      "customer_id", "other_side_bic", "payment_amount", "transaction_fee",
                      "provider_reference", "status", "date_created", "created_by"]
SECU_TOTAL_COLUMNS = ["id", "statement_id", "statement_reference", "value_date",
                      "transaction_date", "type", "ticker", "description", "currency",
                      "quantity", "price", "amount", "fee", "total_amount", "reference",
                      "status", "date_created", "created_by"]

MONEY = (15, 2)
QUANTITY = (15, 6)
PRICE = (15, 8)


def _ordered_list(value: str, order: str, sep: str = ",") -> Column:
    """GROUP_CONCAT(value ORDER BY order SEPARATOR sep); NULLs skipped, '' kept, NULL if no value is left."""
    return ordered_text(value, order, sep)


def _sort_order(sort: list[str], keys: list[str]) -> list[str]:
    """Q14: the reference's ORDER BY plus every remaining key, so numbering is total."""
    return sort + [k for k in keys if k not in sort]


def _collated(raw: DataFrame, keys: list[str], collation: str | None) -> DataFrame:
    """Rows whose keys compare by ``collation`` (e.g. 'UNICODE_CI_AI' groups text the way a
    case/accent-insensitive database collation would, quirk Q7).  Default:
    binary comparison, as the reference's tests run."""
    if collation is None:
        return raw
    return raw.withColumns({k: F.collate(F.col(k), collation) for k in keys})


def list_pieces(raw: DataFrame, keys: list[str], value: str, order_by: str, aggs: list[Column], sep: str = ",",
                part_rows: int = PART_ROWS, cuts: DataFrame | None = None) -> DataFrame:
    """One row per (keys, range of ``order_by``): ``_list``, the range's values in order, and ``aggs``."""
    return (with_parts(raw, keys, [order_by], "_part", part_rows, cuts=cuts).groupBy(*keys, "_part")
            .agg(_ordered_list(value, order_by, sep).alias("_list"), *aggs))


def group_with_list(raw: DataFrame, keys: list[str], value: str, order_by: str, sums: dict[str, Column],
                    averages: dict[str, tuple[Column, int]] | None = None, least: tuple = (), count: str | None = None,
                    sep: str = ",", largest: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Per ``keys``, ``value`` joined in ``order_by`` order, decimal ``sums``, ``averages`` ((decimal,
    its scale) -> 4 more decimals, HALF_UP), minima of the columns ``least``, and the number of rows as ``count``.

    ``largest`` bounds the rows of a group, if the caller knows one; beyond ``part_rows``, or without a
    bound, groups with two sampled cuts (``part_cuts``: large ones, and few of the others) have their lists
    built in ranges, and one aggregate does the rest.  Both ways give the same rows.  ``raw`` is then
    read up to three times, so it should be stored rows.  NULL values are left out of a list and '' kept, so
    a group of NULLs alone has a NULL list.
    """
    averages = averages or {}

    def at_once(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(
            *[F.sum(c).alias(n) for n, c in sums.items()], *[F.avg(c).alias(n) for n, (c, _) in averages.items()],
            _ordered_list(value, order_by, sep).alias(value), *[F.min(c).alias(c) for c in least],
            *([F.count(F.lit(1)).alias(count)] if count else []))
    if largest is not None and largest <= part_rows:
        return at_once(raw)
    # two keys, since any group can have one by chance; a group of few times part_rows fits one task
    cuts = part_cuts(raw, keys, [order_by], part_rows).filter(F.size("_cuts") > 1)
    if cuts.isEmpty():
        return at_once(raw)
    of = cuts.select(*[F.col(k).alias(f"_o{k}") for k in keys])
    small = at_once(raw.join(of, same_keys(raw, of, keys), "left_anti"))
    raw = raw.join(of, same_keys(raw, of, keys), "left_semi")
    # sums and counts of a range; averages follow from those of their groups
    partial = [*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()], *[F.min(c).alias(f"_m_{c}") for c in least]]
    for n, (c, _) in averages.items():
        partial += [F.sum(c).alias(f"_s_{n}"), F.count(c).alias(f"_n_{n}")]
    if count:
        partial.append(F.count(F.lit(1)).alias("_rows"))
    pieces = list_pieces(raw, keys, value, order_by, partial, sep, part_rows, cuts)
    total = lambda n: F.sum(f"_s_{n}").cast(pieces.schema[f"_s_{n}"].dataType)
    ratio = lambda n, s: exact_ratio_text(total(n), F.sum(f"_n_{n}"), s, 0, s + 4).cast(DecimalType(19, s + 4))
    return small.unionByName(pieces.groupBy(*keys).agg(
        *[total(n).alias(n) for n in sums], *[ratio(n, s).alias(n) for n, (_, s) in averages.items()],
        _ordered_list("_list", "_part", sep).alias(value), *[F.min(f"_m_{c}").alias(c) for c in least],
        *([F.coalesce(F.sum("_rows"), F.lit(0).cast("long")).alias(count)] if count else [])))


def aggregate_bank(raw: DataFrame, order_by: str = "transaction_id", collation: str | None = None,
                   largest: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """G1: bank raw -> one row per (statement, 11 keys)."""
    out = group_with_list(
        _collated(raw, BANK_KEYS, collation), ["statement_id", *BANK_KEYS], "provider_reference", order_by,
        {c: to_decimal(c, *MONEY) for c in ("payment_amount", "transaction_fee")}, largest=largest, part_rows=part_rows)
    return out.withColumns({c: F.round(c, 2) for c in ("payment_amount", "transaction_fee")})


def aggregate_secu(raw: DataFrame, order_by: str = "transaction_id", collation: str | None = None,
                   largest: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Securities raw -> one row per (statement, 6 keys); AVG price unweighted (Q20)."""
    return group_with_list(
        _collated(raw, SECU_KEYS, collation), ["statement_id", *SECU_KEYS], "reference", order_by,
        {"quantity": to_decimal("quantity", *QUANTITY), **{c: to_decimal(c, *MONEY) for c in ("amount", "fee", "total_amount")}},
        {"price": (to_decimal("price", *PRICE), PRICE[1])}, largest=largest, part_rows=part_rows)


def number_totals(agg: DataFrame, statements: DataFrame, sort: list[str],
                  keys: list[str]) -> DataFrame:
    """W2 + P16/P17: seq per statement in report order -> 'STMTyyyy.NNN'.

    The numbering reads the groups several times, so they are written first."""
    order = _sort_order(sort, keys)
    numbered = number_by_keys(written(agg), ["statement_id"], order, out="seq")
    prefixes = statements.select(F.col("id").alias("statement_id"),
                                 statement_ref_prefix(F.col("from_date")).alias("_prefix"))
    return (numbered.join(prefixes, "statement_id", "left")
            .withColumn("statement_reference",
                        statement_ref(F.coalesce(F.col("_prefix"), statement_ref_prefix(F.lit(None))),
                                      F.col("seq")))
            .drop("_prefix"))


def _finish(df: DataFrame, columns: list[str], load_id: Column | None) -> DataFrame:
    """K2 columns: stable id, text values with NULL -> '', status/audit constants."""
    out = (df.withColumn("id", stable_id("statement_id", "statement_reference"))
           .withColumn("status", F.lit(TOTAL_DEFAULT_STATUS))
           .withColumn("date_created", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
           .withColumn("created_by", F.lit(SYSTEM_USER)))
    sel = []
    for c in columns:
        col = F.col(c)
        if c not in ("id", "statement_id", "statement_reference", "status", "date_created", "created_by"):
            col = empty_if_null(col.cast("string"))
        sel.append(col.alias(c))
    if load_id is not None:
        sel.append(load_id.alias("load_id"))
    return out.select(*sel)


def consolidate_bank(raw: DataFrame, statements: DataFrame, load_id: Column | None = None,
                     order_by: str = "transaction_id", largest: int | None = None) -> DataFrame:
    """Raw bank rows of many statements -> ``bank_total`` rows; ``largest``: most rows of a statement, if known."""
    agg = aggregate_bank(raw, order_by, largest=largest)
    return _finish(number_totals(agg, statements, BANK_SORT, BANK_KEYS), BANK_TOTAL_COLUMNS, load_id)


def consolidate_secu(raw: DataFrame, statements: DataFrame, load_id: Column | None = None,
                     order_by: str = "transaction_id", largest: int | None = None) -> DataFrame:
    """Raw securities rows of many statements -> ``secu_total`` rows; ``largest`` as for the bank."""
    agg = aggregate_secu(raw, order_by, largest=largest)
    return _finish(number_totals(agg, statements, SECU_SORT, SECU_KEYS), SECU_TOTAL_COLUMNS, load_id)


# ---------------------------------------------------------------------------
# Variants: legacy script (G8-G10), design document (G11/G12), VWAP
# ---------------------------------------------------------------------------

def consolidate(df: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """The generic summary processor -- group by keys, named aggregates."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def _num(c: str) -> Column:
    # the legacy script sums text columns; the database casts them to numbers
    return to_decimal(c, 38, 10)


def legacy_secu(raw: DataFrame) -> DataFrame:
    """Legacy securities summary (ROUND(AVG(price), 2), rounded sums)."""
    return consolidate(raw, ["statement_id", *SECU_KEYS], {
        "quantity": F.sum(_num("quantity")),
        "price": F.round(F.avg(_num("price")), 2),
        "amount": F.round(F.sum(_num("amount")), 2),
        "fee": F.round(F.sum(_num("fee")), 2),
        "total_amount": F.round(F.sum(_num("total_amount")), 2),
    })


def legacy_bank(raw: DataFrame) -> DataFrame:
    """Legacy bank summary (no reference list)."""
    return consolidate(raw, ["statement_id", *BANK_KEYS], {
        "payment_amount": F.round(F.sum(_num("payment_amount")), 2),
        "transaction_fee": F.round(F.sum(_num("transaction_fee")), 2),
    })


def design_bank(raw: DataFrame) -> DataFrame:
    """Design-document bank variant keyed on reference_number; MIN carry-through."""
    keys = ["statement_id", "account_number", "payment_date", "other_side_account",
            "other_side_name", "d_c", "currency", "reference_number"]
    return consolidate(raw, keys, {
        "payment_amount": F.sum(to_decimal("payment_amount", *MONEY)),
        "transaction_fee": F.sum(to_decimal("transaction_fee", *MONEY)),
        "document_nr": F.min("document_nr"),
        "payment_description": F.min("payment_description"),
        "customer_id": F.min("customer_id"),
        "other_side_bic": F.min("other_side_bic"),
        "other_side_bank": F.min("other_side_bank"),
        "transaction_count": F.count(F.lit(1)),
    })


def design_secu(raw: DataFrame, largest: int | None = None) -> DataFrame:
    """Design-document securities variant: (15,4) quantity, (15,6) price,
    references joined by '; ' in reference order, MIN(comment), COUNT(*)."""
    return group_with_list(
        raw, ["statement_id", *SECU_KEYS], "reference", "reference",
        {"quantity": to_decimal("quantity", 15, 4), **{c: to_decimal(c, *MONEY) for c in ("amount", "fee", "total_amount")}},
        {"price": (to_decimal("price", 15, 6), 6)}, least=("comment",), count="transaction_count", sep="; ", largest=largest)


def vwap(raw: DataFrame) -> DataFrame:
    """Volume-weighted price = SUM(amount) / SUM(quantity) per securities group."""
    g = raw.groupBy("statement_id", *SECU_KEYS).agg(
        F.sum(to_decimal("amount", *MONEY)).alias("amount"),
        F.sum(to_decimal("quantity", *QUANTITY)).alias("quantity"))
    return g.withColumn("vwap", exact_ratio_text(F.abs(F.col("amount")), F.col("quantity"), 2, 6, 8))
