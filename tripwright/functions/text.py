"""Text expressions: Unicode trim, strict number and timestamp parsing, fixed-decimal output.

Everything is a built-in expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: the characters Unicode calls White_Space --------------------------------
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# --- end of fixed values -------------------------------------------------------------------

_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_HEX = r"[0-9a-fA-F]+(?:_[0-9a-fA-F]+)*"

INTEGER = r"[+-]?[0-9]+"
FLOAT = (
    rf"(?:[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    rf"|[+-]?0[xX](?:_?{_HEX}(?:\.(?:{_HEX})?)?|\.{_HEX})[pP][+-]?{_DIGITS}"
    r"|[+-]?(?i:inf|infinity)|(?i:nan))"
)
TIMESTAMP = r"[0-9]{4}-[0-9]{2}-[0-9]{2} +[0-9]{1,2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?"

# Accepted text by column type. Spark's casts are wider: they take ``2.0`` or ``1d`` for a number, a
# bare date or a ``T`` for a timestamp. One-digit hours, signs and several spaces are accepted on
# purpose.
TEXT_FORM = {"bigint": INTEGER, "double": FLOAT, "timestamp_ntz": TIMESTAMP}

# The part of those forms that nearly every record is in, cheap to match and to cast as it stands.
PLAIN_FORM = {
    "bigint": r"[0-9]++",
    "double": r"-?+[0-9]++(?:\.[0-9]++)?+",
    "timestamp_ntz": r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}",
}

_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in UNICODE_SPACE) + "]*"
INFINITE_TEXT = r"^[+-]?[iI]"

def trimmed(text: Column) -> Column:
    """Both ends stripped of every Unicode space, not only of U+0020."""
    return F.trim(text, F.lit(UNICODE_SPACE))


def full_match(text: Column, form: str) -> Column:
    return text.rlike(rf"^(?:{form})\z")


def is_form(text: str, type_name: str) -> str:
    """SQL condition: the text is in the accepted form of the type."""
    return f"{text} rlike r'^(?:{TEXT_FORM[type_name]})\\z'"


def line_form(field_forms: dict[int, str], field_count: int, space: str = _SPACE) -> str:
    """Pattern of a whole comma-separated line: the given fields in their form, the rest free.

    One match per line also settles the field count, and costs less than one per field.
    """
    fields = [
        f"{space}{field_forms[i]}{space}" if i in field_forms else "[^,]*+"
        for i in range(field_count)
    ]
    return ",".join(fields)


def canonical_line(line: Column, types: dict[int, str], field_count: int) -> Column:
    """The line in a spelling Spark's casts read, or null if a typed field is in no accepted form.

    Lines in plain spelling pass as they are. Only the others are matched against the full forms
    and rewritten: no space around fields, one space inside timestamps, no digit separators.
    """
    plain = line_form({i: PLAIN_FORM[t] for i, t in types.items()}, field_count, space="")
    accepted = line_form({i: TEXT_FORM[t] for i, t in types.items()}, field_count)
    rewritten = F.regexp_replace(trimmed(line), f"{_SPACE},{_SPACE}", ",")
    rewritten = F.translate(F.regexp_replace(rewritten, " +", " "), "_", "")
    return F.when(full_match(line, plain), line).when(full_match(line, accepted), rewritten)


def parsed(text: str, type_name: str) -> str:
    """SQL expression for the typed value of a canonical field, null out of range.

    Fraction digits past the microsecond are cut off, which is all TIMESTAMP_NTZ can hold. Digits
    that overflow still become infinite here, see :func:`without_overflow`.
    """
    if type_name == "timestamp_ntz":
        return f"try_cast(left({text}, 26) as timestamp_ntz)"
    return f"try_cast({text} as {type_name})"


def without_overflow(value: str, text: str) -> str:
    """SQL expression: null for an infinite value that was not spelled out as one."""
    overflow = f"abs({value}) = double('infinity') and not {text} rlike '{INFINITE_TEXT}'"
    return f"case when {overflow} then null else {value} end"


def lenient(text: str, type_name: str) -> str:
    """SQL expression for number text as it stands: junk and null are 0, overflow the limit.

    Integers stick to the end of the 64-bit range, doubles become infinite.
    """
    if type_name == "double":
        cast = f"try_cast(translate({text}, '_', '') as double)"
    else:
        low, high = "-9223372036854775807L - 1L", "9223372036854775807L"
        limit = f"if(left({text}, 1) = '-', {low}, {high})"
        cast = f"coalesce(try_cast({text} as bigint), {limit})"
    zero = f"cast(0 as {type_name})"
    return f"case when {is_form(text, type_name)} then {cast} else {zero} end"


def with_fixed_decimals(df: DataFrame, wanted: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Adds ``%.{digits}f`` texts: new column -> (double column, digits from 1 to 6).

    The exact binary value is rounded, ties to even. ``format_string`` rounds the shortest decimal
    text half up, so it writes 2.001 for 2.0005, whose binary value lies below the tie. Here
    10^digits times the value is kept as a product and its exact rounding error (Dekker's
    two-product, with the value split in halves), and both decide the last digit.

    The steps are separate projections: each is used several times by the next and would be
    computed as often if written as one expression. A value whose product passes 2^52 has no
    fraction to round and takes the built-in.
    """
    exact, halves, errors, whole, texts = 2.0**52, [], [], [], []
    for i, (name, (source, digits)) in enumerate(wanted.items()):
        unit, x = 10**digits, f"abs({source})"
        halves += [
            f"least({x} * {unit}D, {exact}D) as p_{i}",
            f"{x} * 134217729D - ({x} * 134217729D - {x}) as high_{i}",
        ]
        errors += [
            f"floor(p_{i}) as floor_{i}",
            f"(high_{i} * {unit}D - p_{i}) + ({x} - high_{i}) * {unit}D as error_{i}",
        ]
        tie_up = f"error_{i} > 0 or (error_{i} = 0 and floor_{i} % 2 = 1)"
        whole.append(
            f"""floor_{i} + case when p_{i} - floor_{i} > 0.5D then 1
                                 when p_{i} - floor_{i} = 0.5D and ({tie_up}) then 1
                                 else 0 end as scaled_{i}"""
        )
        negative = f"{source} < 0 or ({source} = 0 and left(cast({source} as string), 1) = '-')"
        texts.append(
            f"""case when isnan({source}) then 'NaN'
                     when {source} = double('infinity') then '+Inf'
                     when {source} = double('-infinity') then '-Inf'
                     when p_{i} >= {exact}D then format_string('%.{digits}f', {source})
                     else concat(if({negative}, '-', ''), scaled_{i} div {unit}, '.',
                                 lpad(scaled_{i} % {unit}, {digits}, '0')) end as {name}"""
        )
    steps = df.selectExpr("*", *halves).selectExpr("*", *errors).selectExpr("*", *whole)
    return steps.selectExpr(*df.columns, *texts)
