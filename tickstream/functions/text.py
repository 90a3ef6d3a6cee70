"""Text expressions, all evaluated in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickstream import constants as c

# Anything between two words.
NON_WORD = r"[^\p{L}\p{N}]+"


def strip_all(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(c.WHITESPACE))


def body_without_tail(content: Column) -> Column:
    """Article body up to the shortening marker, trimmed."""
    return strip_all(F.substring_index(content, c.BODY_TAIL, 1))


def compose_text(title: Column, description: Column, content: Column) -> Column:
    """Labelled parts in one string; NULL and empty parts are left out."""
    parts = (title, description, body_without_tail(content))
    labelled = [
        F.when(part != "", F.concat(F.lit(label), part))
        for label, part in zip(c.PART_LABELS, parts, strict=True)
    ]
    return F.concat_ws(c.PART_SEPARATOR, *labelled)


def words(text: Column) -> Column:
    """The words of a text in lower case."""
    return F.split(F.lower(text), NON_WORD)


def has_all_words(tokens: Column, phrase: str) -> Column:
    """True when every word of the phrase is among the tokens; NULL without tokens."""
    wanted = F.array(*[F.lit(w) for w in re.findall(r"[^\W_]+", phrase.lower())])
    return F.size(F.array_except(wanted, tokens)) == 0


def excerpt(text: Column, chars: int = c.EXCERPT_CHARS) -> Column:
    """The opening characters, followed by dots."""
    return F.concat(F.substring(text, 1, chars), F.lit(c.EXCERPT_END))


def or_unknown(text: Column) -> Column:
    return F.coalesce(text, F.lit(c.UNKNOWN))


def citation(rank: Column, title: Column, source: Column, published: Column,
             score: Column, text: Column) -> Column:
    """One search hit as three lines of text."""
    return F.format_string(
        c.CITATION_FORMAT, rank, or_unknown(title), or_unknown(source),
        or_unknown(published), score, excerpt(F.coalesce(text, F.lit(""))),
    )


def normal_ticker(ticker: Column) -> Column:
    return F.upper(strip_all(ticker))


def money(amount: Column) -> Column:
    return F.format_string(c.MONEY_FORMAT, amount.cast("double"))


def signed_change(change: Column, pct: Column) -> Column:
    """``+1.50 (+2.00%)``; empty when there is no change to show."""
    sign = F.when(change >= 0, F.lit("+")).otherwise(F.lit(""))
    amount = F.concat(sign, F.format_string("%.2f", change))
    share = F.concat(sign, F.format_string("%.2f", pct), F.lit("%"))
    return (
        F.when(change.isNull(), F.lit(""))
        .when(pct.isNull(), amount)
        .otherwise(F.concat(amount, F.lit(" ("), share, F.lit(")")))
    )


def price_text(ticker: Column, close: Column, daily_change: Column, volume: Column,
               high: Column, low: Column, year_high: Column, year_low: Column) -> Column:
    """A price snapshot as lines of text."""
    return F.format_string(
        c.PRICE_FORMAT, ticker, money(close), daily_change, F.format_number(volume, 0),
        money(high), money(low), money(year_high), money(year_low),
    )


def no_price_text(ticker: Column) -> Column:
    return F.format_string(c.NO_PRICE_FORMAT, ticker)
