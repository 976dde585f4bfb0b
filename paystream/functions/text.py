"""Strict decoding of record values: UTF-8, then exactly one JSON document.

Like all of :mod:`paystream.functions`, these take and give SQL expressions as text: a contract
has hundreds of small expressions, and each Column call would be a round trip to the JVM.
"""

from __future__ import annotations


def as_text(value: str) -> str:
    """Bytes as text without changing them; a null value is empty, so it is refused, not lost."""
    return f"cast(coalesce({value}, X'') AS STRING)"


def readable(value: str) -> str:
    """Bytes as text, undecodable parts shown as U+FFFD."""
    return f"make_valid_utf8({as_text(value)})"


def json_in_array(text: str) -> str:
    """``text`` parsed as the only element of an array, or NULL.

    Spark's JSON parser stops after the first value and ignores what follows; the brackets make
    it read up to the end. Use together with :func:`is_single_json`.
    """
    return f"try_parse_json(concat('[', {text}, ']'))"


def is_single_json(text: str, parsed: str) -> str:
    """Whether ``text`` is one JSON value and nothing else; ``parsed`` is its array form.

    Without a ``]`` in the text the array can only have been closed by our own bracket, so one
    element means one value. With a ``]`` a second reading inside an object decides: no trailing
    text closes both an array and an object.
    """
    in_object = f"""json_object_keys(concat('{{"w":', {text}, '}}')) IS NOT NULL"""
    one = (
        f"variant_get({parsed}, '$[0]', 'variant') IS NOT NULL "
        f"AND variant_get({parsed}, '$[1]', 'variant') IS NULL"
    )
    return (
        f"{parsed} IS NOT NULL AND "
        f"CASE WHEN contains({text}, ']') THEN {in_object} ELSE {one} END"
    )


def read_in_array(text: str, schema: str) -> str:
    """``text`` read as the only element of an array of structs; NULL or short if it is not."""
    # NaN and infinities may stand in fields nobody reads; as a declared value they are no number.
    strict = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'true')"
    return f"from_json(concat('[', {text}, ']'), 'array<{schema}>', {strict})"


def is_surely_text(value: str) -> str:
    """Whether a value ``from_json`` read as STRING was a JSON string for certain.

    ``from_json`` also accepts other tokens and returns them as they are written. They all look
    like a number, a literal, an object or an array; text of that look needs a second check.
    """
    return rf"NOT ({value} RLIKE r'^([{{\[]|([-0-9][-+.0-9eE]*|true|false)$)')"


def text_of(variant: str, kind: str) -> str:
    """The text of a JSON string, NULL for any other type."""
    return f"CASE WHEN {kind} = 'STRING' THEN try_variant_get({variant}, '$', 'string') END"


def integer_of(variant: str, kind: str) -> str:
    """The value of a JSON integer of 64 bits, NULL for any other type (1.0, 1e3 and true are none)."""
    return f"CASE WHEN {kind} = 'BIGINT' THEN try_variant_get({variant}, '$', 'bigint') END"


def token_of(text: str, name: str) -> str:
    """A field of a JSON object as it is written; of several equal keys the first one's."""
    return f"get_json_object({text}, '$.{name}')"


def is_other_number(kind: str) -> str:
    """Whether a variant holds a number that is no integer of 64 bits."""
    return f"({kind} LIKE 'DECIMAL%' OR {kind} = 'DOUBLE')"


def wide_integer_of(token: str, kind: str) -> str:
    """The digits of a JSON integer beyond 64 bits, NULL for any other value.

    ``token`` is the value read as text. Variants keep 38 digits at most and drop ".0", the
    token of an integer is written out whole.
    """
    return f"CASE WHEN {is_other_number(kind)} AND {token} RLIKE '^-?[0-9]+$' THEN {token} END"
