"""The data contract: an ordered list of rules, checked row by row.

A rule is a SQL predicate that is true when the rule is broken, so a contract is
plain data and a check is one projection inside whole-stage code generation, the
same for a batch and for a stream.  Every predicate is guarded against NULL: a row
is either valid or not, never unknown.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate import settings as fixed
from sluicegate.functions.exact import number
from sluicegate.functions.once import computed_once
from sluicegate.functions.times import parse_iso, seconds_between

EVENT_TIME = "parsed_event_ts"
FRESHNESS = "freshness_sec"
# The column that holds an event's own time, unless a contract names another.
EVENT_TS = "event_ts"


@dataclass(frozen=True)
class Rule:
    """One clause: its code, its flag and counter columns, and when it is broken."""

    code: str
    flag: str
    counter: str
    broken: str


def _named(code: str, name: str, broken: str) -> Rule:
    return Rule(code, f"v_{name}", f"cnt_{name}", broken)


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def present(code: str, name: str, column: str) -> Rule:
    """The column is neither NULL nor empty; blanks count as present."""
    return _named(code, name, f"{column} IS NULL OR char_length({column}) = 0")


def in_range(code: str, name: str, column: str, low: float, high: float) -> Rule:
    """The number lies in ``[low, high]``; NULL and NaN do not."""
    return _named(code, name, f"{column} IS NULL OR {column} < {number(low)} OR {column} > {number(high)}")


def one_of(code: str, name: str, column: str, allowed: tuple[str, ...]) -> Rule:
    """The text is one of ``allowed``, case included."""
    listed = ", ".join(_text(value) for value in allowed)
    return _named(code, name, f"{column} IS NULL OR {column} NOT IN ({listed})")


def parseable_time(code: str, name: str) -> Rule:
    """The event's own time could be parsed."""
    return _named(code, name, f"{EVENT_TIME} IS NULL")


def fresh(code: str, name: str, max_age_seconds: int) -> Rule:
    """The event was at most ``max_age_seconds`` old on receipt.

    An unparseable time has no age, so it never breaks this rule as well.
    """
    return _named(code, name, f"coalesce({FRESHNESS} > {max_age_seconds}, false)")


@dataclass(frozen=True)
class Contract:
    """Rules in the order in which violations are listed.

    ``tie_order`` decides which of equally frequent codes is the top reason; without
    it the rules' own order does.  ``time_column`` holds the event's own time, as text.
    """

    rules: tuple[Rule, ...]
    tie_order: tuple[str, ...] = ()
    time_column: str = EVENT_TS

    @property
    def counters(self) -> dict[str, str]:
        """Counter column of each code, in the order that decides ties."""
        by_code = {rule.code: rule.counter for rule in self.rules}
        return {code: by_code[code] for code in self.tie_order or by_code}

    def check(self, raw: DataFrame) -> DataFrame:
        """Add the parsed time, the freshness, one flag per rule and the violations."""
        timed = computed_once(raw, EVENT_TIME, parse_iso(f"`{self.time_column}`"))
        aged = timed.selectExpr("*", f"{seconds_between(EVENT_TIME, 'received_time')} AS {FRESHNESS}")
        flagged = aged.selectExpr("*", *[f"({rule.broken}) AS {rule.flag}" for rule in self.rules])
        # Joined arrays compile; dropping the NULLs of one array would not.
        found = [f"CASE WHEN {rule.flag} THEN array({_text(rule.code)}) ELSE array() END" for rule in self.rules]
        return flagged.selectExpr("*", f"CAST(concat({', '.join(found)}) AS ARRAY<STRING>) AS violations")

    def verdict(self, checked: DataFrame) -> DataFrame:
        """Add ``is_valid``: no rule is broken.

        Derived from the flags rather than from the array, so that a filter on it
        never makes Spark build the array for rows that are filtered out.
        """
        return checked.withColumn("is_valid", F.expr(f"NOT ({' OR '.join(rule.flag for rule in self.rules)})"))

    def judge(self, raw: DataFrame) -> DataFrame:
        return self.verdict(self.check(raw))


ORDER_EVENTS = Contract(
    (
        present(fixed.MISSING_EVENT_ID, "missing_id", "event_id"),
        present(fixed.MISSING_USER_ID, "missing_user", "user_id"),
        in_range(fixed.AMOUNT_OUT_OF_RANGE, "amount_range", "amount", fixed.AMOUNT_MIN, fixed.AMOUNT_MAX),
        one_of(fixed.INVALID_CURRENCY, "bad_currency", "currency", fixed.CURRENCIES),
        parseable_time(fixed.MALFORMED_TIMESTAMP, "bad_timestamp"),
        fresh(fixed.STALE_EVENT, "stale", fixed.MAX_AGE_SECONDS),
    ),
    fixed.TIE_ORDER,
)
