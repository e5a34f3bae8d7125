"""Identifiers: option symbols, tickers, vendor codes, multi-valued cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import OPTION_SYMBOL, SUPPORTED_UNDERLYING


#: Characters of a symbol behind its underlying: expiry, type and strike have fixed widths.
_TAIL = 15


def option_fields(ticker: Column) -> dict[str, Column]:
    """underlying, expiration_date, option_type and strike of an option symbol; all null if it doesn't parse.

    One regular expression tells whether a symbol parses; its fields are cut out by place.
    """
    text = F.upper(F.trim(ticker))
    own = F.when(text.rlike(OPTION_SYMBOL), text)
    kind = F.substring(own, 6 - _TAIL, 1)
    return {
        "underlying": F.substr(own, F.lit(3), F.length(own) - _TAIL - 2),
        "expiration_date": F.try_to_date(F.substring(own, -_TAIL, 6), "yyMMdd"),
        "option_type": F.when(kind == "C", "call").when(kind == "P", "put"),
        "strike": F.substring(own, -8, 8).cast("long") / F.lit(1000.0),
    }


def parse_options(df: DataFrame, ticker: str = "ticker") -> DataFrame:
    return df.withColumns(option_fields(F.col(ticker)))


def normalized_underlying(c: Column) -> Column:
    """Trimmed and upper-cased, without one trailing digit if letters precede it; null stays null."""
    return F.regexp_replace(F.upper(F.trim(c)), r"^(\p{L}+)[0-9]$", "$1")


def supported_underlying(c: Column) -> Column:
    return F.coalesce(c.rlike(SUPPORTED_UNDERLYING), F.lit(False))


def index_ticker(c: Column) -> Column:
    """An index member's ticker: cut at the first full stop, then slashes become full stops; blank is null."""
    return F.nullif(F.replace(F.substring_index(F.upper(F.trim(c)), ".", 1), F.lit("/"), F.lit(".")), F.lit(""))


def simple_ticker(c: Column) -> Column:
    return F.upper(F.trim(c))


def vendor_ticker(c: Column) -> Column:
    return F.replace(c, F.lit("."), F.lit("-"))


def cleaned_code(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def split_cell(c: Column) -> Column:
    """Parts of a delimited cell: semicolons if there are any, else commas; trimmed, blanks dropped."""
    parts = F.when(F.instr(c, ";") > 0, F.split(c, ";")).otherwise(F.split(c, ","))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def exploded_members(df: DataFrame, code: str, ticker: str, name: str, order: str | None = None) -> DataFrame:
    """Cells with several codes, tickers and names, one row per position; a missing ticker falls back to the code.

    The first row of a ticker wins, in the order of the column ``order`` (if
    given) and of positions; the other columns that ``df`` keeps, such as a
    snapshot's date, separate tickers.  Rows without ticker and code are dropped.
    """
    cells = (F.coalesce(split_cell(F.col(c)), F.array().cast("array<string>")).alias(a) for c, a in ((code, "code"), (ticker, "ticker"), (name, "name")))
    zipped = df.select("*", F.posexplode(F.arrays_zip(*cells)).alias("place", "m"))
    keep = [c for c in df.columns if c not in (code, ticker, name, order)]
    rank = F.struct(*([F.col(order).alias("o")] if order else []), F.col("place").alias("p"), F.col("m.code").alias("c"), F.col("m.name").alias("n"))
    rows = zipped.select(*keep, "place", F.col("m.code").alias("original_ric"), index_ticker(F.coalesce("m.ticker", "m.code")).alias("ticker"), F.col("m.name").alias("name"), rank.alias("_rank")).filter("ticker is not null")
    first = rows.groupBy(*keep, "ticker").agg(F.min_by(F.struct("place", "original_ric", "name"), "_rank").alias("_r"))
    return first.select(*keep, "_r.place", "_r.original_ric", "ticker", "_r.name")


def class_share_codes(symbol: Column) -> Column:
    """Vendor codes of the two class shares that are written without a separator."""
    root, cls = F.regexp_extract(symbol, "^([A-Z]+)([AB])$", 1), F.regexp_extract(symbol, "^([A-Z]+)([AB])$", 2)
    codes = F.array(F.concat(root, F.lower(cls), F.lit(".N")), F.concat(root, F.lower(cls), F.lit(".OQ")), F.concat(root, F.lit("."), cls, F.lit(".N")), F.concat(root, F.lit("/"), cls, F.lit(".N")))
    return F.when(symbol.isin("BFB", "BRKB"), codes).otherwise(F.array().cast("array<string>"))


def generic_codes(symbol: Column) -> Column:
    root, cls = F.substring_index(symbol, ".", 1), F.lower(F.regexp_replace(symbol, r"^[^.]*\.", ""))
    dotted = F.array(F.concat(root, cls, F.lit(".N")), F.concat(root, cls, F.lit(".OQ")))
    plain = F.array(*(F.concat(symbol, F.lit(x)) for x in (".N", ".OQ", ".O", "")))
    return F.when(F.instr(symbol, ".") > 0, dotted).otherwise(plain)


def code_candidates(symbol: Column, aliases: Column, known: Column) -> Column:
    """Candidate codes in order of trust, each once: aliases, those of snapshots, class shares, generic forms."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(aliases, empty), F.coalesce(known, empty), class_share_codes(symbol), generic_codes(symbol)))
