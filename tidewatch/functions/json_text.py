"""Strict JSON acceptance and tolerant typing, as column expressions.

A document is parsed once into a VARIANT that wraps it in an array, with the
hash of its text behind it. A text cannot hold its own hash, so an array that
ends in it was closed by the wrapper and not by the text. Every later question
(type, path, value) is asked of that one parsed value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.session import allow_duplicate_keys

_NUL_ESCAPE = r"(?<!\\)((?:\\\\)*)\\u0000"
_LONE_HIGH = r"(?<!\\)(?:\\\\)*\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F])"
_LONE_LOW = (
    r"(?<!\\u[dD][89abAB][0-9a-fA-F]{2})(?<!\\)(?:\\\\)*\\u[dD][c-fC-F][0-9a-fA-F]{2}"
)
# Texts of a member that do not say which type it had, where that decides how it
# is spelled: containers, booleans, numbers a float would print differently.
_TYPE_MATTERS = (
    r"^([\[{]|true$|false$|-0|-?\d+\.\d+0$|-?0\.000|-?\d+(\.\d*)?[eE]|[-\d.]{17,}$)"
)
# A decimal without digits after the point that would have fitted a BIGINT was
# written with a point ("7.0"); a genuine integer of that size is a BIGINT.
_WHOLE_DECIMAL = r"^DECIMAL\((\d|1[0-8]),0\)$"


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, whatever is built on them.

    The optimizer copies an ordinary projection into every filter and expression
    above it, which for a parsed document would mean parsing it again for each
    use. It does not look into the one-row generator used here.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def strip_line_end(text: Column) -> Column:
    return F.regexp_replace(text, r"[\r\n]+$", "")


def utf8_text(value: Column) -> Column:
    """Text of the bytes, without a byte-order mark; NULL if not UTF-8."""
    text = value.cast("string")
    return F.when(
        F.is_valid_utf8(text),
        F.when(text.startswith("\ufeff"), F.substring(text, 2, 2_147_483_647)).otherwise(text),
    )


def replace_nul(text: Column) -> Column:
    """Turn an escaped U+0000 into U+FFFD; the cheap search guards the regex."""
    return F.when(
        F.contains(text, F.lit("\\u0000")),
        F.regexp_replace(text, _NUL_ESCAPE, r"$1\\ufffd"),
    ).otherwise(text)


def has_lone_surrogate(text: Column) -> Column:
    suspicious = F.contains(text, F.lit("\\ud")) | F.contains(text, F.lit("\\uD"))
    return F.coalesce(
        suspicious & (text.rlike(_LONE_HIGH) | text.rlike(_LONE_LOW)), F.lit(False)
    )


def _seal(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def parse_document(text: Column) -> Column:
    """VARIANT array of the document and the hash of its text, or NULL if that is not JSON."""
    allow_duplicate_keys()
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), _seal(text), F.lit('"]')))


def is_single_value(document: Column, text: Column) -> Column:
    """True if the parsed wrapper around text holds exactly one JSON value."""
    return F.coalesce(
        (F.try_variant_get(document, "$[1]", "string") == _seal(text))
        & F.try_variant_get(document, "$[2]", "variant").isNull(),
        F.lit(False),
    )


def is_json(text: Column) -> Column:
    """Strict JSON test of a text column: one value and nothing after it."""
    return is_single_value(parse_document(text), text)


def opens_object(text: Column) -> Column:
    """For valid JSON text: whether its value is an object."""
    return F.coalesce(text.rlike(r"^[ \t\r\n]*\{"), F.lit(False))


def with_members(df: DataFrame, text: Column, schema: str, name: str = "_row") -> DataFrame:
    """Add the members of a JSON object as a struct; NULL if the text is anything else.

    A member whose value does not fit its type is NULL and leaves its neighbours
    alone. String members keep the text the value was written with, whatever its
    type; see typed_scalar.
    """
    allow_duplicate_keys()
    rows = F.from_json(
        F.concat(F.lit("["), text, F.lit(',{"_seal":"'), _seal(text), F.lit('"}]')),
        f"array<struct<{schema}, _seal string>>",
        {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"},
    )
    read = computed_once(df, _rows=rows)
    sealed = (F.size("_rows") == 2) & (F.col("_rows")[1]["_seal"] == _seal(text))
    only = F.when(sealed & opens_object(text), F.col("_rows")[0])
    return computed_once(read, **{name: only}).drop("_rows")


def type_matters(members: list[str]) -> Column:
    """Whether some member's text reads differently depending on the type it had
    (true, 1.50, [1] and so on). Members may be strings or string arrays."""
    return F.expr(f"concat_ws('\\n', {', '.join(members)}) RLIKE r'(?m){_TYPE_MATTERS}'")


# The expressions below are written as SQL text: one of them is a single call to
# the JVM, where building it from column functions would be dozens.
#
# `document` names a parsed document for rows where types matter and NULL for all
# others, where the member's own text (`text`) is already the answer.


def _at(document: str, path: str, kind: str) -> str:
    return f"try_variant_get({document}, '$[0]{path}', '{kind}')"


def _kind(document: str, path: str) -> str:
    return f"schema_of_variant({_at(document, path, 'variant')})"


def _spelled(text: str, kind: str) -> str:
    """Scalar text of a known type, as booleans and whole floats are spelled."""
    return f"""CASE WHEN {kind} IN ('STRING', 'BIGINT') THEN {text}
        WHEN {kind} = 'BOOLEAN' THEN initcap({text})
        WHEN {kind} RLIKE r'{_WHOLE_DECIMAL}' THEN {text} || '.0'
        WHEN {kind} LIKE 'DECIMAL%' OR {kind} = 'DOUBLE' THEN {text} END"""


def typed_scalar(text: str, document: str, path: str) -> Column:
    """Scalar member as text; NULL for null, arrays and objects."""
    spelled = _spelled(_at(document, path, "string"), _kind(document, path))
    return F.expr(f"CASE WHEN {document} IS NULL THEN {text} ELSE {spelled} END")


def typed_list(texts: str, document: str, path: str) -> Column:
    """A string as a one-element list, a list as its scalars, anything else empty."""
    items = _at(document, path, "array<variant>")
    spelled = _spelled("try_variant_get(item, '$', 'string')", "schema_of_variant(item)")
    return F.expr(f"""
        CASE WHEN {document} IS NULL THEN coalesce({texts}, cast(array() AS array<string>))
             WHEN {items} IS NOT NULL
             THEN filter(transform({items}, item -> {spelled}), text -> text IS NOT NULL)
             WHEN {_kind(document, path)} = 'STRING' THEN array({_at(document, path, 'string')})
             ELSE cast(array() AS array<string>) END""")


def typed_small_int(text: str, document: str, path: str, highest: int = 32767) -> Column:
    """Whole number in 0..highest from an int, float, boolean or digit string."""
    kind = _kind(document, path)
    number = rf"""
        CASE WHEN {text} RLIKE r'^\d{{1,9}}$' THEN try_cast({text} AS bigint)
             WHEN {text} RLIKE r'^\s*[+-]?\d+(_\d+)*\s*$'
             THEN try_cast(replace(regexp_replace({text}, r'^\s+|\s+$', ''), '_', '') AS bigint)
             WHEN {kind} = 'BOOLEAN' THEN if({text} = 'true', 1, 0)
             WHEN {kind} LIKE 'DECIMAL%' OR {kind} = 'DOUBLE'
             THEN try_cast({_at(document, path, 'double')} AS bigint) END"""
    return F.expr(f"CASE WHEN {number} BETWEEN 0 AND {highest} THEN cast({number} AS smallint) END")


def string_member(text: str, document: str, path: str) -> Column:
    """Text of a string member; NULL for every other type."""
    return F.expr(f"""
        CASE WHEN {document} IS NULL THEN {text}
             WHEN {_kind(document, path)} = 'STRING' THEN {_at(document, path, 'string')} END""")


def member_int(raw: Column, name: str) -> Column:
    """Top-level member cast to int; a repeated key means its last value."""
    return F.from_json(raw, f"`{name}` string")[name].cast("int")
