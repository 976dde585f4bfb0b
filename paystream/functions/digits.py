"""Whole numbers of any size: columns of 64 bits where that is enough, decimal digits where not.

A number has two columns, ``narrow BIGINT`` and ``wide STRING``; one of them is null. Sums run
over limbs of 18 digits, and one carry at the end makes digits of them. SQL text, see
:mod:`paystream.functions.text`.
"""

from __future__ import annotations

LIMB = 18
_BASE = f"cast({10**LIMB} AS DECIMAL(38,0))"


def is_integer(narrow: str, wide: str) -> str:
    return f"({narrow} IS NOT NULL OR {wide} IS NOT NULL)"


def is_positive(narrow: str, wide: str) -> str:
    """NULL if there is no number."""
    return f"coalesce({narrow} > 0, NOT startswith({wide}, '-'))"


def is_negative(narrow: str, wide: str) -> str:
    return f"coalesce({narrow} < 0, startswith({wide}, '-'))"


def digits_of(narrow: str, wide: str) -> str:
    return f"coalesce({wide}, cast({narrow} AS STRING))"


def narrow_of(digits: str) -> str:
    """``digits`` as 64 bits, NULL if they do not fit."""
    return f"try_cast({digits} AS BIGINT)"


def wide_of(digits: str) -> str:
    """``digits`` where they do not fit 64 bits, else NULL."""
    return f"CASE WHEN {narrow_of(digits)} IS NULL THEN {digits} END"


def limbs(narrow: str, wide: str) -> str:
    """A number above zero as ``array<struct<place, part>>``, the lowest place first.

    A narrow one is a single part as it is.
    """
    part = (
        f"cast(substring({wide}, greatest(length({wide}) - {LIMB} * (k + 1) + 1, 1), "
        f"least({LIMB}, length({wide}) - {LIMB} * k)) AS DECIMAL(20,0))"
    )
    places = f"sequence(0, (length({wide}) + {LIMB - 1}) div {LIMB} - 1)"
    many = f"transform({places}, k -> struct(cast(k AS INT) AS place, {part} AS part))"
    one = f"array(struct(0 AS place, cast({narrow} AS DECIMAL(20,0)) AS part))"
    return f"CASE WHEN {wide} IS NULL THEN {one} ELSE {many} END"


def carried(parts: str) -> str:
    """Digits of the number whose sums by place are ``array<struct<place, part DECIMAL(38,0)>>``.

    All places up to the greatest must be there, in any order; sums may exceed a limb.
    """
    here = "(x.part + acc.over)"
    digits = f"lpad(cast(cast({here} % {_BASE} AS DECIMAL({LIMB},0)) AS STRING), {LIMB}, '0')"
    folded = (
        f"aggregate(array_sort({parts}), "
        "named_struct('digits', '', 'over', cast(0 AS DECIMAL(38,0))), "
        f"(acc, x) -> named_struct('digits', concat({digits}, acc.digits), "
        f"'over', cast({here} div {_BASE} AS DECIMAL(38,0))), "
        "acc -> concat(cast(acc.over AS STRING), acc.digits))"
    )
    alone = f"cast(get({parts}, 0).part AS STRING)"
    return f"CASE WHEN size({parts}) = 1 THEN {alone} ELSE regexp_replace({folded}, '^0+(?=[0-9])', '') END"
