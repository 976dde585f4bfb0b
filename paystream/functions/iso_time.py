"""ISO-8601 text to instants and back, with built-in functions; SQL expressions as text."""

from __future__ import annotations

# The shape nearly all writers use, which Spark's own cast reads exactly ...
_COMMON = (
    r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?"
    r"(Z|[+-]0[0-9]:[0-5][0-9]|[+-]1[0-7]:[0-5][0-9])$"
)
# ... and every other form: calendar or week date, extended or basic, any one separator,
# time cut after hours, minutes or seconds, zone optional.
_DATE = (
    r"(?s)^(?:([0-9]{4})(?:-([0-9]{2})-([0-9]{2})|([0-9]{2})([0-9]{2}))"
    r"|([0-9]{4})(?:-W([0-9]{2})(?:-([0-9]))?|W([0-9]{2})([0-9])?))"
)
_CLOCK = (
    r"(?:.(?:([0-9]{2})(?::([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?)?"
    r"|([0-9]{2})([0-9]{2})(?:([0-9]{2})(?:[.,]([0-9]+))?)?)"
)
_ZONE = r"(Z|([+-])([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?)"
_FULL = _DATE + _CLOCK + _ZONE + "?)?$"
_ZONED = _DATE + _CLOCK + _ZONE + ")$"
_GROUPS = 24


class _Parts:
    """The groups of one matched text, in the lambda variable ``g``; absent ones are NULL."""

    @staticmethod
    def text(*indexes: int) -> str:
        return f"coalesce({', '.join(f"nullif(get(g, {i - 1}), '')" for i in indexes)})"

    def number(self, *indexes: int, default: int | None = None) -> str:
        found = self.text(*indexes)
        return f"cast({found if default is None else f"coalesce({found}, '{default}')"} AS INT)"

    def micros(self, *indexes: int) -> str:
        """Digits after the point as microseconds, further digits cut off."""
        return f"cast(rpad(coalesce({self.text(*indexes)}, '0'), 6, '0') AS BIGINT)"

    def day(self) -> str:
        """Days since 1970, NULL where there is no such day."""
        year, week = self.number(1, 6), self.number(7, 9)
        weekday = self.number(8, 10, default=1)
        calendar = (
            f"try_cast(concat_ws('-', {self.text(1)}, {self.text(2, 4)}, {self.text(3, 5)})"
            " AS DATE)"
        )
        # Week 1 is the one with 4 January; the last week of a year is the one with 28 December.
        first = f"cast(date_trunc('week', make_date({year}, 1, 4)) AS DATE)"
        by_week = (
            f"CASE WHEN {week} BETWEEN 1 AND weekofyear(make_date({year}, 12, 28)) "
            f"AND {weekday} BETWEEN 1 AND 7 "
            f"THEN date_add({first}, ({week} - 1) * 7 + {weekday} - 1) END"
        )
        day = f"CASE WHEN {week} IS NULL THEN {calendar} ELSE {by_week} END"
        return f"CASE WHEN {year} >= 1 THEN cast(unix_date({day}) AS BIGINT) END"

    def second(self) -> str:
        """Seconds since midnight, NULL where there is no such time."""
        hour = self.number(11, 15, default=0)
        minute = self.number(12, 16, default=0)
        second = self.number(13, 17, default=0)
        return (
            f"CASE WHEN {hour} < 24 AND {minute} < 60 AND {second} < 60 "
            f"THEN {hour} * 3600 + {minute} * 60 + {second} END"
        )

    def zone_micros(self) -> str:
        """Offset from UTC; NULL if a whole day or more."""
        size = (
            f"(({self.number(21, default=0)} * 3600 + {self.number(22, default=0)} * 60 + "
            f"{self.number(23, default=0)}) * 1000000L + {self.micros(24)})"
        )
        return (
            f"CASE WHEN {size} < 86400000000L "
            f"THEN CASE WHEN {self.text(20)} = '-' THEN -{size} ELSE {size} END END"
        )

    def instant(self) -> str:
        return (
            f"timestamp_micros(({self.day()} * 86400 + {self.second()}) * 1000000L "
            f"+ {self.micros(14, 18)} - {self.zone_micros()})"
        )


def _general(text: str) -> str:
    """Any ISO-8601 text. Lambdas keep this long expression out of the generated hot code."""
    marks = ",".join(f"${i}" for i in range(1, _GROUPS + 1))
    groups = (
        f"transform(array({text}), t -> split(regexp_replace(t, r'{_FULL}', '{marks}'), ',', -1))"
    )
    return f"get(transform({groups}, g -> {_Parts().instant()}), 0)"


def is_common_iso8601(text: str) -> str:
    return f"coalesce({text} RLIKE r'{_COMMON}', false)"


def parse_iso8601(text: str, common: str | None = None) -> str:
    """The instant, or NULL if the text is no ISO-8601 time. Text without zone is read as UTC.

    The common shape costs one match and one cast; the long form is only evaluated for the rest.
    """
    return (
        f"CASE WHEN {common or is_common_iso8601(text)} THEN try_cast({text} AS TIMESTAMP) "
        f"WHEN {text} RLIKE r'{_FULL}' THEN {_general(text)} END"
    )


def has_zone(text: str, common: str | None = None) -> str:
    """Whether a time text ends in a zone (Z or an offset)."""
    return f"({common or is_common_iso8601(text)} OR coalesce({text} RLIKE r'{_ZONED}', false))"


def format_boundary(ts: str) -> str:
    """Window bound as text: UTC, milliseconds, ``Z``."""
    return f"""date_format({ts}, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")"""
