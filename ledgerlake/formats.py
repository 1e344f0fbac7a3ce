"""Format registry, positional column mappings and dedup key positions.

Adding a format (X5) = ``register_layout``; the rest of the library reads it
from here.  The registry is turned into a tiny literal DataFrame (``format_registry``) so
the per-statement format facts are joined, never looked up on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour (text, in order).
# ---------------------------------------------------------------------------

# Layout name -> (account type, separator, header rule keywords).
# Detection rules are checked in this order; all keywords of a rule must occur
# in the lower-cased, quote-stripped first line.
DETECTION_RULES = [
    ("SECURITIES", ["väärtuspäev", "tehingupäev"]),
    ("LHV_BANK", ["dokumendi number"]),
    ("SWEDBANK", ["dok nr"]),
]

# Header lines of the three layouts, cell by cell (used to write fixtures and
# round-trip files; detection itself only looks for the keywords above).
LHV_HEADER = [
    "Kliendi konto", "Dokumendi number", "Kuupäev", "Saaja/maksja konto",
    "Saaja/maksja nimi", "Saaja panga kood", "Tühi", "Deebet/Kreedit (D/C)", "Summa",
    "Viitenumber", "Arhiveerimistunnus", "Selgitus", "Teenustasu", "Valuuta",
    "Isikukood või registrikood", "Saaja/maksja panga BIC", "Makse algataja nimi",
    "Kande viide", "Konto teenusepakkuja viide",
]
SWEDBANK_HEADER = [
    "Kliendi konto", "Dok nr", "Makse kuupäev", "Saaja/maksja konto", "Saaja/maksja nimi",
    "Saaja/maksja pank", "D/C", "Summa", "Viitenumber", "Arhiveerimistunnus", "Selgitus",
    "Teenustasu", "Valuuta", "Isikukood/registrikood",
]
SECURITIES_HEADER = [
    "VÄÄRTUSPÄEV", "TEHINGUPÄEV", "TEHING", "SÜMBOL", "VÄÄRTPABER", "KOGUS", "HIND",
    "VALUUTA", "NETOSUMMA", "TEENUSTASU", "KOKKU", "VIIDE", "KOMMENTAAR",
]

# Mapped bank columns, in CSV position order after the LHV blank cell 6 is removed.
BANK_COLUMNS = [
    "account_number", "document_nr", "payment_date", "other_side_account",
    "other_side_name", "other_side_bank", "d_c", "payment_amount",
    "reference_number", "archival_number", "payment_description",
    "transaction_fee", "currency", "customer_id", "other_side_bic",
    "initiator", "transaction_reference", "provider_reference",
]

# Mapped securities columns, in CSV position order.
SECU_COLUMNS = [
    "value_date", "transaction_date", "type", "ticker", "description",
    "quantity", "price", "currency", "amount", "fee", "total_amount",
    "reference", "comment",
]

# Dedup keys: primary key position, composite key positions (in key order).
BANK_PRIMARY_KEY_INDEX = 17          # provider_reference
BANK_COMPOSITE_INDICES = [0, 1, 2, 7, 12]  # account, document_nr, payment_date, amount, currency
SECU_PRIMARY_KEY_INDEX = 11          # reference
SECU_COMPOSITE_INDICES = [0, 1, 2, 3, 8, 7]  # value_date, transaction_date, type, ticker, amount, currency

# Legacy (BeanShell) detection: the separator found in the raw first line picks
# the rule family (';' is tested first), then all three keywords must occur.
# Unmatched headers fall back to the default comma layout (no escape char).
# Tuple: (layout, separator, keywords, backslash escape).
LEGACY_DETECTION_RULES = [
    ("SWEDBANK", ";", ["kliendi konto", "dok nr", "makse kuupäev"], False),
    ("SECURITIES", ",", ["väärtuspäev", "tehingupäev", "tehing"], True),
    ("LHV_BANK", ",", ["kliendi konto", "dokumendi number", "kuupäev"], True),
]
LEGACY_DEFAULT_LAYOUT = "DEFAULT"

# Status chain of a statement (README of the reference): new -> importing ->
# imported -> consolidating -> consolidated; any state -> error.
STATUS_CHAIN = ["new", "importing", "imported", "consolidating", "consolidated"]
ALLOWED_TRANSITIONS = [
    ("new", "importing"),
    ("importing", "imported"),
    ("imported", "consolidating"),
    ("consolidating", "consolidated"),
    # re-runs of the same record
    ("imported", "importing"),
    ("consolidated", "consolidating"),
    ("consolidated", "importing"),
    ("error", "importing"),
    ("error", "consolidating"),
]

SYSTEM_USER = "system"
TOTAL_DEFAULT_STATUS = "new"
ERROR_MESSAGE_LIMIT = 1000
UNKNOWN_ERROR = "Unknown error"


@dataclass(frozen=True)
class Layout:
    name: str
    account_type: str
    separator: str
    target: str
    columns: tuple[str, ...]          # mapped target columns, index = array position
    strip_index: int | None           # cell removed before mapping (LHV only)


FORMATS: dict[str, Layout] = {
    "LHV_BANK": Layout("LHV_BANK", "bank", ",", "bank_raw", tuple(BANK_COLUMNS), 6),
    "SWEDBANK": Layout("SWEDBANK", "bank", ";", "bank_raw", tuple(BANK_COLUMNS[:14]), None),
    "SECURITIES": Layout("SECURITIES", "secu", ",", "secu_raw", tuple(SECU_COLUMNS), None),
}


def register_layout(layout: Layout, keywords: list[str]) -> None:
    """Add a layout whose header holds all keywords (lower case, no quotes).

    Its rule is tried after the existing ones.  ``columns`` are columns of the
    account type's raw table, in cell order; the table's other columns stay NULL.
    """
    table = BANK_COLUMNS if layout.account_type == "bank" else SECU_COLUMNS
    unknown = [c for c in layout.columns if c not in table]
    if unknown:
        raise ValueError(f"{layout.name}: not columns of a {layout.account_type} statement: {unknown}")
    if len(layout.separator) != 1:
        raise ValueError(f"{layout.name}: the separator must be one character")
    FORMATS[layout.name] = layout
    DETECTION_RULES[:] = [r for r in DETECTION_RULES if r[0] != layout.name] + [(layout.name, keywords)]


def format_registry(spark: SparkSession) -> DataFrame:
    """The registry as a 3-row DataFrame (fixed size: safe to broadcast)."""
    rows = [(f.name, f.account_type, f.separator, f.target, f.strip_index)
            for f in FORMATS.values()]
    return spark.createDataFrame(
        rows, "format string, account_type string, separator string, target string, strip_index int")
