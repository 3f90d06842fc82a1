import random
from datetime import date, datetime, timedelta

import pytest
from tests.conftest import rows

from stratalake.operators import history_apply, history_close, history_insert
from stratalake.schemas import SILVER

COLUMNS = SILVER["employee_clean_history"]
OPEN = date(9999, 12, 31)
DAY = date(2024, 1, 1)


def day(n):
    return None if n is None else (OPEN if n >= 999 else DAY + timedelta(days=n))


def version(employee, start, change_hash, end=999, arrived=0, current=True):
    return (
        employee, "code", "s", "store", day(start), day(end), current, True, change_hash, "f",
        datetime(2024, 6, 1) + timedelta(hours=arrived),
    )


@pytest.fixture
def versions(spark):
    return lambda *vs: spark.createDataFrame(list(vs), COLUMNS)


def closed_by_hand(target, source):
    """Every current row against every new version of its employee."""
    out = []
    for t in target:
        t = list(t)
        if t[6] and t[4] is not None:
            hits = [
                s for s in source
                if s[0] == t[0] and s[4] is not None and t[4] <= s[4] <= t[5] and s[8] != t[8]
            ]
            if hits:
                start = min(s[4] for s in hits)
                arrived = max(s[10] for s in hits if s[4] == start)
                t[5], t[6], t[10] = start - timedelta(days=1), False, max(t[10], arrived)
        out.append(tuple(t))
    return sorted(out, key=repr)


def test_close_on_the_day_before_the_change(versions):
    got = history_close(versions(version("1", 0, "a")), versions(version("1", 10, "b", arrived=5)))
    assert rows(got) == [version("1", 0, "a", end=9, arrived=5, current=False)]


def test_same_hash_or_other_employee_does_not_close(versions):
    target = versions(version("1", 0, "a"))
    assert rows(history_close(target, versions(version("1", 10, "a"), version("2", 10, "b")))) == rows(target)


def test_closed_rows_and_starts_outside_the_interval_do_not_close(versions):
    target = versions(version("1", 0, "a", end=5), version("2", 0, "a", current=False), version("3", 20, "a"))
    source = versions(*(version(e, 10, "b") for e in "123"))
    assert rows(history_close(target, source)) == rows(target)


def test_interval_ends_are_inclusive(versions):
    target = versions(version("1", 0, "a", end=10), version("2", 10, "a"))
    got = history_close(target, versions(version("1", 10, "b"), version("2", 10, "b")))
    assert rows(got, "employee_id", "effective_to") == [("1", day(9)), ("2", day(9))]


def test_restated_start_leaves_an_inverted_interval(versions):
    got = history_close(versions(version("1", 10, "a")), versions(version("1", 10, "b"))).first()
    assert (got.effective_from, got.effective_to, got.is_current) == (day(10), day(9), False)


def test_earliest_of_several_new_versions_closes(versions):
    source = versions(version("1", 30, "c"), version("1", 20, "b"), version("1", 15, "a"))
    got = history_close(versions(version("1", 10, "a")), source).first()
    assert got.effective_to == day(19)


def test_arrival_time_never_goes_back(versions):
    got = history_close(versions(version("1", 0, "a", arrived=9)), versions(version("1", 5, "b", arrived=1)))
    assert got.first().imported_date == version("1", 0, "a", arrived=9)[10]


def test_rows_without_start_pass_through(versions):
    target = versions(version("1", None, "a"))
    assert rows(history_close(target, versions(version("1", None, "b"), version("1", 3, "c")))) == rows(target)


@pytest.mark.parametrize("seed", range(4))
def test_close_matches_brute_force(versions, seed):
    """Employee 0 owns a third of all versions on both sides."""
    pick = random.Random(seed)

    def some(n):
        made = {}
        for _ in range(n):
            employee = "0" if pick.random() < 0.34 else str(pick.randrange(1, 8))
            start, change_hash = pick.randrange(12), pick.choice("abc")
            end = 999 if pick.random() < 0.5 else start + pick.randrange(6)
            made[employee, start, change_hash] = version(
                employee, start, change_hash, end, pick.randrange(50), pick.random() < 0.8
            )
        return list(made.values())

    target, source = some(120), some(60)
    assert rows(history_close(versions(*target), versions(*source))) == closed_by_hand(target, source)


def test_insert_flags_all_new_versions_current_unless_derived(versions):
    target, source = versions(version("1", 0, "a")), versions(version("1", 0, "a"), version("1", 5, "b", end=9, current=False), version("1", 10, "c"))
    assert rows(history_insert(target, source), "change_hash", "is_current") == [("a", True), ("b", True), ("c", True)]
    derived = history_insert(target, source, derive_current=True)
    assert rows(derived, "change_hash", "is_current") == [("a", True), ("b", False), ("c", True)]


def test_repeated_versions_are_added_once(versions):
    source = versions(version("1", 0, "a"), version("1", 0, "a"), version("1", 0, "a", arrived=3))
    once = history_insert(versions(), source)
    assert rows(once) == [version("1", 0, "a", arrived=3)]
    assert rows(history_insert(once, source)) == rows(once)


def test_apply_twice_is_apply_once(versions):
    target = versions(version("1", 0, "a"), version("2", 0, "x"))
    source = versions(version("1", 10, "b"), version("3", 1, "q"))
    once = history_apply(target, source)
    assert rows(once, "employee_id", "change_hash", "effective_to", "is_current") == [
        ("1", "a", day(9), False),
        ("1", "b", OPEN, True),
        ("2", "x", OPEN, True),
        ("3", "q", OPEN, True),
    ]
    assert rows(history_apply(once, source)) == rows(once)
