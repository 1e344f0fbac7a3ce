"""String helpers: trimming, header normalisation, references, word lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..formats import ERROR_MESSAGE_LIMIT, UNKNOWN_ERROR

# Java String.trim() removes every code point <= U+0020 at both ends (P7).  btrim with these
# characters does that without a regex; text that ends in one of the line ends beyond U+0020, which
# "$" looks past, takes the regex.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
_JAVA_BLANKS = "".join(map(chr, range(0x21)))
_LINE_ENDS = ("\u0085", "\u2028", "\u2029")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    x = _c(c)
    return F.when(F.substring(x, -1, 1).isin(*_LINE_ENDS), F.regexp_replace(x, _JAVA_TRIM, "")).otherwise(
        F.btrim(x, F.lit(_JAVA_BLANKS)))


def ordered_text(value: str, order: str, sep: str) -> Column:
    """Aggregate: the non-NULL ``value``s joined in ``order`` (NULLs first); NULL if there is none.

    ``listagg ... WITHIN GROUP`` gives the same, but took 10.3 s by a struct where this takes 1.5 s (737,677 rows).
    """
    found = F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("order"), F.col(value).alias("value"))))
    return F.when(F.size(found) > 0, F.array_join(F.sort_array(found)["value"], sep))


def empty_if_null(c) -> Column:
    """NULL -> ''."""
    return F.coalesce(_c(c), F.lit(""))


def normalise_header(c) -> Column:
    """Drop both quote characters, then lower-case."""
    return F.lower(F.regexp_replace(_c(c), "[\"']", ""))


def zero_pad(n, width: int = 3) -> Column:
    """%03d style padding; never truncates (lpad would cut 1234 to 123)."""
    n = _c(n)
    # numbers that need no zeros, or a sign, are most or all: format_string makes a formatter for each row
    return F.when(n >= 10 ** (width - 1), n.cast("string")).otherwise(F.format_string(f"%0{width}d", n))


def statement_ref_prefix(from_date) -> Column:
    """P16: 'STMT' + year of from_date; NULL or shorter than 4 -> current year."""
    fd = _c(from_date)
    year = (F.when(fd.isNotNull() & (F.length(fd) >= 4), F.substring(fd, 1, 4))
            .otherwise(F.date_format(F.current_date(), "yyyy")))
    return F.concat(F.lit("STMT"), year)


def statement_ref(prefix, seq) -> Column:
    """P17: '<prefix>.NNN'."""
    return F.concat(F.coalesce(_c(prefix), F.lit("null")), F.lit("."), zero_pad(seq))


def truncate_error(msg) -> Column:
    """At most 1000 characters, NULL -> 'Unknown error'."""
    m = _c(msg)
    return F.when(m.isNull(), F.lit(UNKNOWN_ERROR)).otherwise(F.substring(m, 1, ERROR_MESSAGE_LIMIT))


def words_match(words, text, if_empty: bool, skip_empty_words: bool = True) -> Column:
    """Does any comma-separated word occur in text (case-insensitive)?

    An empty or NULL word list yields ``if_empty``.  The reference lets an empty
    word (``"a,,b"``) match everything; ``skip_empty_words`` (default) drops
    such words instead (quirk Q17).  Trailing empty words are always dropped,
    as Java's ``split`` does.
    """
    w = _c(words)
    t = F.lower(_c(text))
    parts = F.split(F.regexp_replace(w, ",+$", ""), ",")
    cleaned = F.transform(parts, lambda x: F.lower(java_trim(x)))
    if skip_empty_words:
        cleaned = F.filter(cleaned, lambda x: x != "")
    hit = F.exists(cleaned, lambda x: t.contains(x))
    return F.when(w.isNull() | (w == ""), F.lit(if_empty)).otherwise(F.coalesce(hit, F.lit(False)))


def includes_words(words, text, skip_empty_words: bool = True) -> Column:
    return words_match(words, text, True, skip_empty_words)


def excludes_words(words, text, skip_empty_words: bool = True) -> Column:
    return words_match(words, text, False, skip_empty_words)
