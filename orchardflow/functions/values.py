"""Normalisers of cleaned text as native column expressions. Each gives struct<value, code>: code says why there is no value.

A normaliser is a list of steps, each a few named columns made from those before. On a frame (:func:`staged`) each step is a generator of one row whose struct
holds the parts: it is compiled with the rest of the stage, and the optimiser neither merges the steps, which would repeat the parts, nor derives
constraints from them, which would multiply as they do for the aliases of projections. As one column (:func:`as_column`) each part is a lambda's variable, which is
interpreted; that form is for places where only an expression fits.

Null text has neither value nor code. ``(?U)`` makes the patterns' classes those of Unicode; digits outside ASCII are found but rejected
as unparsable.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchardflow.schemas import ZERO_DECIMAL_CURRENCIES

# Currency symbols, longest first; other currency codes that texts may state.
SYMBOLS = (("CHF", "CHF"), ("R$", "BRL"), ("£", "GBP"), ("$", "USD"), ("€", "EUR"), ("¥", "JPY"), ("₹", "INR"), ("₩", "KRW"))
CODES = ("GBP", "USD", "EUR", "JPY", "INR", "KRW", "BRL", "CHF", "AUD", "CAD", "CNY", "DKK", "NOK", "NZD", "PLN", "SEK", "SGD")
# Month names and abbreviations.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
# Rating words; stock phrases, the first rule that matches holds.
RATING_WORDS = ("zero", "one", "two", "three", "four", "five")
STOCK_PHRASES = (
    ("discontinued", ("discontinued", "no longer available", "withdrawn")),
    ("out_of_stock", ("out of stock", "out-of-stock", "sold out", "unavailable", "not in stock")),
    ("preorder", ("pre-order", "preorder", "pre order", "coming soon")),
    ("in_stock", ("in stock", "in-stock", "available", "ships", "add to basket")),
)
# The notations that are accepted, as patterns. Which texts match decides which records are rejected, so they cannot differ.
CODE = r"(?U)\b([A-Z]{3})\b"
NUMBER = r"(?U)\d[\d.,'\s]*\d|\d"
AGO = r"^([0-9]+) (day|days|week|weeks|hour|hours|minute|minutes) ago$"
ISO_DATE = r"^([0-9]{4})-([0-9]{2})-([0-9]{2})(?:[T ].*)?$"
MONTH_FIRST = r"^([A-Za-z]+)\.?\s+([0-9]{1,2})(?:st|nd|rd|th)?,?\s+([0-9]{4})$"
DAY_FIRST = r"^([0-9]{1,2})(?:st|nd|rd|th)?\s+([A-Za-z]+)\.?,?\s+([0-9]{4})$"
THREE_NUMBERS = r"^([0-9]{1,4})[/.-]([0-9]{1,2})[/.-]([0-9]{2,4})$"
SCALED = r"(?U)(\d+(?:[.,]\d+)?)\s*(?:/|out\s+of|of)?\s*(\d+)?"

#: From a getter of the columns so far to the next named columns; the last step names its one column "result".
Step = Callable[[Callable[[str], Column]], dict[str, Column]]


def as_column(text: Column, steps: list[Step]) -> Column:
    """The steps, of which the first get ``text``, as one column: each step's columns are a lambda's variable for the next, so that nothing is computed twice."""

    def go(get: Callable[[str], Column], names: list[str], rest: list[Step]) -> Column:
        new = rest[0](get)
        if len(rest) == 1:
            return new["result"]
        every = F.struct(*(get(n).alias(n) for n in names), *(c.alias(k) for k, c in new.items()))
        return F.element_at(F.transform(F.array(every), lambda x: go(lambda n: x[n], [*names, *new], rest[1:])), 1)

    return F.element_at(F.transform(F.array(text), lambda x: go(lambda _: x, ["text"], steps)), 1)


def staged(df: DataFrame, **made: tuple[Column, list[Step]]) -> DataFrame:
    """``df`` with a column more for each of ``made``, the result of its steps on its text; all take their steps side by side."""
    columns, here = df.columns, "_stage"
    held = {name: ["text"] for name in made}
    now = df.select(*columns, F.explode(F.array(F.struct(*(text.alias(f"{name}__text") for name, (text, _) in made.items())))).alias(here))
    for i in range(max(len(steps) for _, steps in made.values())):
        parts = []
        for name, (_, steps) in made.items():
            get = lambda part, name=name: F.col(here)[f"{name}__{part}"]
            new = steps[i](get) if i < len(steps) else {"result": get("result")}
            if i + 1 >= len(steps):
                parts.append(new["result"].alias(f"{name}__result"))
            else:
                parts += [get(x).alias(f"{name}__{x}") for x in held[name]] + [c.alias(f"{name}__{x}") for x, c in new.items()]
                held[name] += list(new)
        now = now.select(*columns, F.explode(F.array(F.struct(*parts))).alias(here))
    return now.select(*columns, *(F.col(here)[f"{name}__result"].alias(name) for name in made))


def _column(x: Column | str | date | None) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _first(condition_values: list[tuple[Column, Column]], otherwise: Column) -> Column:
    chain = None
    for condition, value in condition_values:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return otherwise if chain is None else chain.otherwise(otherwise)


def minor_digits(currency: Column) -> Column:
    """Decimal places of a currency's amounts."""
    return F.when(currency.isin(*ZERO_DECIMAL_CURRENCIES), 0).otherwise(2)


def amount_text(currency: Column, minor: Column) -> Column:
    """Minor units as a decimal string at the currency's scale, without floats."""
    digits = F.lpad(minor.cast("string"), 3, "0")
    padded = F.when(F.length(minor.cast("string")) < 3, digits).otherwise(minor.cast("string"))
    whole = F.substring(padded, F.lit(1), F.length(padded) - 2)
    return F.when(minor_digits(currency) == 0, minor.cast("string")).otherwise(F.concat(whole, F.lit("."), F.right(padded, F.lit(2))))


def currency_of(text: Column, default: Column | str | None = None) -> Column:
    """The first word of three capitals if it is a known code; else a symbol's currency; else the default."""
    code = F.regexp_extract(text, CODE, 1)
    symbol = _first([(F.contains(text, F.lit(s)), F.lit(c)) for s, c in SYMBOLS], F.lit(None))
    return F.coalesce(F.when(code.isin(*CODES), code), symbol, _column(default))


def plain_number(run: Column, separator: Column | str = "auto") -> Column:
    """A run of digits and separators as digits with at most one point, by the rules for grouping and decimal separators."""
    return as_column(run, _number_steps("text", _column(separator)))


def _number_steps(name: str, separator: Column) -> list[Step]:
    def count(get):
        run = get(name)
        no_dots, no_commas = F.replace(run, F.lit("."), F.lit("")), F.replace(run, F.lit(","), F.lit(""))
        return {"no_dots": no_dots, "no_commas": no_commas, "tail": F.length(F.substring_index(F.replace(run, F.lit(","), F.lit(".")), ".", -1)), "dot_last": F.instr(F.reverse(run), ".") < F.instr(F.reverse(run), ",")}

    def read(get):
        run = get(name)
        dots, commas = F.length(run) - F.length(get("no_dots")), F.length(run) - F.length(get("no_commas"))
        with_point = F.replace(run, F.lit(","), F.lit("."))
        grouped = lambda n, declared: (n > 1) | ((get("tail") == 3) & (separator != declared))
        number = (
            F.when((dots > 0) & (commas > 0), F.when(get("dot_last"), get("no_commas")).otherwise(F.replace(get("no_dots"), F.lit(","), F.lit("."))))
            .when(dots > 0, F.when(grouped(dots, "dot"), get("no_dots")).otherwise(run))
            .when(commas > 0, F.when(grouped(commas, "comma"), get("no_commas")).otherwise(with_point))
            .otherwise(run)
        )
        return {"result": number}

    return [count, read]


def money_steps(separator: Column | str = "auto", default_currency: Column | str | None = None, strict_sign: bool = False) -> list[Step]:
    """The steps of :func:`money`."""
    counted, read = _number_steps("run", _column(separator))

    def settle(get):
        text, currency, minor = get("text"), get("currency"), get("minor")
        fits = get("number").rlike(r"^[0-9]+(\.[0-9]+)?$") & (F.length(get("fraction")) <= minor_digits(currency))
        bad = F.coalesce(~fits | minor.isNull(), F.lit(True))
        negative = text.rlike(r"-\s*[^0-9\s]{0,3}\s*[0-9]") if strict_sign else F.lit(False)
        return {"code": F.when(text.isNull(), None).when(currency.isNull(), "no_currency").when(bad, "unparsable").when(negative, "out_of_range")}

    def result(get):
        value = F.when(get("text").isNotNull() & get("code").isNull(), F.struct(get("currency").alias("currency"), get("minor").alias("minor")))
        return {"result": F.struct(value.alias("value"), get("code").alias("code"))}

    return [
        lambda get: {"currency": currency_of(get("text"), default_currency), "run": F.regexp_replace(F.regexp_extract(get("text"), NUMBER, 0), r"(?U)[\s']", "")},
        counted,
        lambda get: {"number": read(get)["result"]},
        lambda get: {"whole": F.regexp_extract(get("number"), r"^([0-9]+)", 1), "fraction": F.regexp_replace(F.regexp_extract(get("number"), r"^[0-9]+\.([0-9]+)$", 1), "0+$", "")},
        lambda get: {"minor": F.concat(get("whole"), F.rpad(get("fraction"), minor_digits(get("currency")), "0")).try_cast("bigint")},
        settle,
        result,
    ]


def money(text: Column, separator: Column | str = "auto", default_currency: Column | str | None = None, strict_sign: bool = False) -> Column:
    """struct<value: struct<currency, minor>, code> of a price text.

    Codes: ``no_currency`` if nothing names one, which is settled first; ``unparsable`` without a number, for an ill-formed number and
    for more decimal places than the currency has. Only the first number counts, and a sign before it is ignored unless ``strict_sign``,
    which rejects it as ``out_of_range``.
    """
    return as_column(text, money_steps(separator, default_currency, strict_sign))


def date_steps(today: Column | date, order: Column | str = "dmy", hours_as_days: bool = True) -> list[Step]:
    """The steps of :func:`listing_date`."""
    today, order = _column(today), _column(order)
    names = [x for i, m in enumerate(MONTHS, 1) for x in {m: i, m[:3]: i}.items()] + [("sept", 9)]
    numbers = F.create_map(*(F.lit(v) for pair in names for v in pair))

    def kinds(get):
        text, low = get("text"), F.lower(get("text"))
        kind = F.when(low.isin("today", "yesterday"), low)
        for name, subject, pattern in (("ago", low, AGO), ("iso", text, ISO_DATE), ("month_first", text, MONTH_FIRST), ("day_first", text, DAY_FIRST), ("three", text, THREE_NUMBERS)):
            kind = kind.when(subject.rlike(pattern), name)
        return {"kind": kind}

    def pieces(get):
        text, kind = get("text"), get("kind")
        part = lambda i: F.when(kind == "iso", F.regexp_extract(text, ISO_DATE, i)).when(kind == "month_first", F.regexp_extract(text, MONTH_FIRST, i)).when(kind == "day_first", F.regexp_extract(text, DAY_FIRST, i)).when(kind == "three", F.regexp_extract(text, THREE_NUMBERS, i)).when(kind == "ago", F.regexp_extract(F.lower(text), AGO, i) if i < 3 else None)
        return {"a": part(1), "b": part(2), "c": part(3)}

    def ordered(get):
        """Which piece is the year, the month and the day."""
        kind, a, b, c = get("kind"), get("a"), get("b"), get("c")
        year_first = (kind == "iso") | ((kind == "three") & (F.length(a) == 4))
        year = F.when(year_first, a).otherwise(c).try_cast("int")
        month = F.when(year_first, b).when((kind == "month_first") | ((kind == "three") & (order == "mdy")), a).otherwise(b)
        day = F.when(year_first, c).when((kind == "month_first") | ((kind == "three") & (order == "mdy")), b).otherwise(a)
        return {
            "year": F.when((kind == "three") & ~year_first & (year < 100), year + 2000).otherwise(year),
            "month": F.when(kind.isin("month_first", "day_first"), F.element_at(numbers, F.lower(month))).otherwise(month.try_cast("int")),
            "day": day.try_cast("int"),
            "n": a.try_cast("int"),
        }

    def days(get):
        n, unit = get("n"), get("b")
        short = F.when(unit.startswith("hour"), F.floor(n / 24)).when(unit.startswith("minute"), F.floor(n / 1440)).otherwise(n)
        back = F.when(unit.startswith("week"), F.when(n < 400_000, n * 7)).otherwise(n if hours_as_days else short.cast("int"))
        kind = get("kind")
        stated = F.when(F.coalesce((get("year") >= 1) & get("month").isNotNull(), F.lit(False)) & kind.isin("iso", "month_first", "day_first", "three"), F.format_string("%04d-%02d-%02d", get("year"), get("month"), get("day")))
        return {"days": F.when(kind == "today", 0).when(kind == "yesterday", 1).when(kind == "ago", back), "stated": stated.try_cast("date")}

    def result(get):
        days = get("days")
        ago = F.when((days >= 0) & (days <= F.datediff(today, F.lit("0001-01-01").cast("date"))), F.date_sub(today, days))
        return {"value": F.coalesce(ago, get("stated"))}

    return [kinds, pieces, ordered, days, result, lambda get: {"result": F.struct(get("value").alias("value"), F.when(get("text").isNotNull() & get("value").isNull(), "unparsable").alias("code"))}]


def listing_date(text: Column, today: Column | date, order: Column | str = "dmy", hours_as_days: bool = True) -> Column:
    """struct<value: date, code> of a date text; relative ones count from ``today``.

    "N hours ago" and "N minutes ago" go back N days, unless not ``hours_as_days``: then whole days only. There is no year 0.
    """
    return as_column(text, date_steps(today, order, hours_as_days))


def rating_steps() -> list[Step]:
    """The steps of :func:`rating`."""

    def word(get):
        low = get("low")
        return {"word": _first([(low.rlike(rf"(?U)\b{w}\b"), F.lit(float(i))) for i, w in enumerate(RATING_WORDS)], F.lit(None).cast("double")), "number": F.replace(F.regexp_extract(low, SCALED, 1), F.lit(","), F.lit(".")).try_cast("double"), "stated": F.regexp_extract(low, SCALED, 2)}

    def scaled(get):
        scale = F.when(get("stated") == "", F.lit(5)).otherwise(get("stated").try_cast("int"))
        return {"value": F.when(scale == 10, get("number") / 2).when(scale == 5, get("number"))}

    def code(get):
        value = get("value")
        return {"code": F.when(get("text").isNull() | get("word").isNotNull(), None).when(value.isNull(), "unparsable").when(~value.between(0.0, 5.0), "out_of_range")}

    def result(get):
        return {"result": F.struct(F.coalesce(get("word"), F.when(get("code").isNull(), F.round(get("value"), 2))).alias("value"), get("code").alias("code"))}

    return [lambda get: {"low": F.lower(get("text"))}, word, scaled, code, result]


def rating(text: Column) -> Column:
    """struct<value: double, code> of a rating text on a scale of 5: a word, or a number with an optional scale of 5 or 10.

    Rounds half up at two decimals.
    """
    return as_column(text, rating_steps())


def availability(text: Column) -> Column:
    """Stock status of a text: ``unknown`` if no phrase is in it, null for null."""
    low = F.lower(text)
    rules = []
    for status, phrases in STOCK_PHRASES:
        found = F.contains(low, F.lit(phrases[0]))
        for phrase in phrases[1:]:
            found = found | F.contains(low, F.lit(phrase))
        rules.append((found, F.lit(status)))
    return F.when(text.isNotNull(), _first(rules, F.lit("unknown")))
