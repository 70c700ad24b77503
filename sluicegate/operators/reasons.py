"""Top failure reason of a window, in its three variants, as SQL expressions."""

from __future__ import annotations

from sluicegate.operators.contract import ORDER_EVENTS, Contract
from sluicegate.operators.metrics import first_seen
from sluicegate.settings import NO_REASON


def _code_of_largest(candidates: list[str]) -> str:
    """Code of the largest candidate struct, which compares by count first."""
    best = f"array_max(array({', '.join(candidates)}))"
    return f"CASE WHEN {best}.n > 0 THEN {best}.code ELSE '{NO_REASON}' END"


def most_frequent(contract: Contract = ORDER_EVENTS) -> str:
    """The most frequent code; of equal counts the one the contract prefers."""
    return _code_of_largest(
        [
            f"named_struct('n', {counter}, 'place', {-place}, 'code', '{code}')"
            for place, (code, counter) in enumerate(contract.counters.items())
        ]
    )


def first_occurring(contract: Contract = ORDER_EVENTS) -> str:
    """The contract's most preferred code that occurred at all, however rarely."""
    found = [f"CASE WHEN {counter} > 0 THEN '{code}' END" for code, counter in contract.counters.items()]
    return f"coalesce({', '.join(found)}, '{NO_REASON}')"


def most_frequent_first_seen(contract: Contract = ORDER_EVENTS) -> str:
    """The most frequent code; of equal counts the one seen first in the window.

    Codes first broken by the same event keep the contract's order.
    """
    return _code_of_largest(
        [
            f"named_struct('n', {rule.counter}, 'seen', -unix_micros({first_seen(rule.counter)}),"
            f" 'place', {-place}, 'code', '{rule.code}')"
            for place, rule in enumerate(contract.rules)
        ]
    )
