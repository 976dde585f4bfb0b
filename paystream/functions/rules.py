"""Building blocks for JSON contracts: decode fields strictly, one error code per broken rule.

Expressions are SQL text, see :mod:`paystream.functions.text`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from paystream.functions.digits import is_integer, is_negative, is_positive
from paystream.functions.text import (
    as_text,
    integer_of,
    is_other_number,
    is_single_json,
    is_surely_text,
    json_in_array,
    read_in_array,
    text_of,
    token_of,
    wide_integer_of,
)

BAD_ENCODING = "encoding:value"
BAD_JSON = "syntax:value"
NO_OBJECT = "type:value"


def _flat(name: str) -> str:
    return name.replace(".", "_")


class Fields:
    """The declared fields of a JSON object: dotted name -> ``"text"`` or ``"integer"``.

    :meth:`read` decodes them once, in a chain of projections in which each step only uses
    finished columns; rules and outputs then refer to :meth:`value`, and for integers beyond 64
    bits to :meth:`wide`.
    """

    def __init__(self, declared: Mapping[str, str]) -> None:
        self.declared = dict(declared)

    def _ddl(self, leaf_types: Mapping[str, str]) -> str:
        tree: dict = {}
        for name, leaf in leaf_types.items():
            *parents, last = name.split(".")
            node = tree
            for parent in parents:
                node = node.setdefault(parent, {})
            node[last] = leaf

        def ddl(node: dict | str) -> str:
            if isinstance(node, str):
                return node
            return f"struct<{', '.join(f'{name} {ddl(sub)}' for name, sub in node.items())}>"

        return ddl(tree)

    def read(self, records: DataFrame, value: str = "value") -> DataFrame:
        """Decode the bytes in column ``value``.

        A first, typed reading serves nearly every record. Where it leaves any doubt about the
        type of a field, the record is parsed again into variants, which tell absent from null
        and an integer from 1.0, true or "1". Only where an integer field then holds a number
        that is no integer of 64 bits, its digits are read as they are written.
        """
        sql_types = {"text": "string", "integer": "bigint"}
        typed = self._ddl({name: sql_types[how] for name, how in self.declared.items()})
        untyped = self._ddl(dict.fromkeys(self.declared, "variant"))
        integers = [name for name, how in self.declared.items() if how == "integer"]
        certain = all_hold(*(
            is_surely_text(f"_read.{name}") if how == "text" else f"_read.{name} IS NOT NULL"
            for name, how in self.declared.items()
        ))
        plain = "_utf8 AND NOT contains(_text, ']')"
        frame = (
            records.selectExpr("*", f"{as_text(value)} AS _text")
            .selectExpr("*", "is_valid_utf8(_text) AS _utf8")
            .selectExpr("*", f"CASE WHEN {plain} THEN {read_in_array('_text', typed)} END "
                             "AS _list")
            .selectExpr("*", "CASE WHEN size(_list) = 1 THEN get(_list, 0) END AS _read")
            .selectExpr("*", f"{certain} AS _certain")
            .selectExpr("*", "CASE WHEN _utf8 AND NOT _certain "
                             f"THEN {json_in_array('_text')} END AS _array")
            .selectExpr("*", f"({is_single_json('_text', '_array')}) AS _single")
            .selectExpr("*", "CASE WHEN _single "
                             f"THEN try_variant_get(_array, '$[0]', '{untyped}') END AS _object")
            .selectExpr("*", *(
                f"schema_of_variant(_object.{name}) AS {self.kind(name)}"
                for name in self.declared
            ))
        )
        decode = {"text": text_of, "integer": integer_of}
        return frame.selectExpr("*", *(
            f"CASE WHEN _certain THEN _read.{name} "
            f"ELSE {decode[how](f'_object.{name}', self.kind(name))} END AS {self.value(name)}"
            for name, how in self.declared.items()
        ), *(
            f"{wide_integer_of(token_of('_text', name), self.kind(name))} AS {self.wide(name)}"
            for name in integers
        ))

    def kind(self, name: str) -> str:
        """Type of the field, only known where the quick reading was not certain."""
        return f"_kind_{_flat(name)}"

    def value(self, name: str) -> str:
        """Decoded value; NULL if absent or of another type."""
        return f"_val_{_flat(name)}"

    def wide(self, name: str) -> str:
        """Digits of an integer beyond 64 bits, whose :meth:`value` is NULL."""
        return f"_wide_{_flat(name)}"

    def is_integer(self, name: str) -> str:
        return is_integer(self.value(name), self.wide(name))

    def is_positive(self, name: str) -> str:
        """NULL if it is no integer."""
        return is_positive(self.value(name), self.wide(name))

    def is_negative(self, name: str) -> str:
        """NULL if it is no integer."""
        return is_negative(self.value(name), self.wide(name))

    def is_missing(self, name: str) -> str:
        """The key is absent. JSON null is present."""
        return f"({self.value(name)} IS NULL AND {self.kind(name)} IS NULL)"

    def is_empty(self, name: str) -> str:
        """Not a JSON string, or an empty one. Blanks count as text."""
        return f"({self.value(name)} IS NULL OR {self.value(name)} = '')"

    def is_none_of(self, name: str, allowed: Sequence[str]) -> str:
        choices = ", ".join(f"'{choice}'" for choice in allowed)
        return f"({self.value(name)} IS NULL OR {self.value(name)} NOT IN ({choices}))"

    def error(self, name: str, *checks: tuple[str, str]) -> str:
        """The first broken rule of a field as ``rule:name``, NULL if all hold."""
        whens = " ".join(f"WHEN {broken} THEN '{rule}:{name}'" for rule, broken in checks)
        return f"CASE WHEN {self.is_missing(name)} THEN 'missing:{name}' {whens} END"

    def object_error(self, name: str) -> str:
        """Error of a nested object: absent, or no object; NULL if it is one."""
        absent = f"variant_get(_array, '$[0].{name}', 'variant') IS NULL"
        return (
            f"CASE WHEN NOT {self.is_object(name)} "
            f"THEN CASE WHEN {absent} THEN 'missing:{name}' ELSE 'type:{name}' END END"
        )

    def is_object(self, name: str) -> str:
        return f"(_certain OR _object.{name} IS NOT NULL)"


def decoding_error() -> str:
    """Why a value is no JSON object in UTF-8; NULL if it is one."""
    return (
        f"CASE WHEN _certain THEN NULL WHEN NOT _utf8 THEN '{BAD_ENCODING}' "
        f"WHEN NOT _single THEN '{BAD_JSON}' WHEN _object IS NULL THEN '{NO_OBJECT}' END"
    )


def all_hold(*conditions: str) -> str:
    """Whether every condition is true; unknown counts as broken."""
    return f"coalesce({' AND '.join(f'({c})' for c in conditions)}, false)"


def collect_errors(*errors: str) -> str:
    """All broken rules, in the order given."""
    return f"array_compact(array({', '.join(errors)}))"


def settle(frame: DataFrame, columns: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Select ``keep`` and ``columns`` so that later filters on them do not repeat the work.

    Catalyst copies a computed column into every filter above it, which for parsed JSON means
    parsing each record again per filter. Predicates do not pass an ``inline``, so the columns
    are handed out through one over a single-element array.
    """
    kept = [f"`{name}`" for name in keep]
    finished = frame.selectExpr(*kept, *(f"{sql} AS _out_{n}" for n, sql in columns.items()))
    row = ", ".join(f"'{n}', _out_{n}" for n in columns)
    return finished.selectExpr(*kept, f"inline(array(named_struct({row})))")
