"""Breakdowns from one cube against the same from the lines."""

import pytest

from orderlens.__main__ import BREAKDOWNS
from orderlens.operators.cube import cube
from orderlens.operators.filters import Filters, apply_filters
from orderlens.plans import explore


def rows(df):
    return df.columns, sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def selection(house):
    return apply_filters(house.fact(), Filters(month_from="1993-01"))


@pytest.fixture(scope="module")
def held(selection):
    return explore.breakdown_cube(selection)


@pytest.mark.parametrize("name", BREAKDOWNS)
def test_breakdowns_equal_those_from_lines(name, selection, held):
    assert rows(BREAKDOWNS[name](held)) == rows(BREAKDOWNS[name](selection))


def test_no_lines(make_fact):
    none = make_fact({}).limit(0)
    held = explore.breakdown_cube(none)
    assert explore.is_empty(held)
    for name, breakdown in BREAKDOWNS.items():
        assert rows(breakdown(held)) == rows(breakdown(none)), name


def test_missing_keys_flags_and_orders(make_fact):
    lines = make_fact(
        {"order_id": 1, "sales": 5}, {"order_id": 1, "sales": None}, {"order_id": None, "sales": 7}, {"market": None},
        {"delivery_status": None, "order_region": None}, {"customer_segment": None, "order_id": 64}, {"order_id": -3},
        {"order_status": "CANCELED", "delivery_status": "Shipping canceled", "category_name": None, "order_id": 2**40},
    )
    held = explore.breakdown_cube(lines)
    assert not explore.is_empty(held)
    for name, breakdown in BREAKDOWNS.items():
        assert rows(breakdown(held)) == rows(breakdown(lines)), name
    assert rows(explore.average_basket(held)) == rows(explore.average_basket(lines))


def test_no_breakdown_of_a_cube_reads_the_fact(house, selection, held):
    plan = selection.sparkSession._jvm.PythonSQLUtils.explainString
    folder = selection.inputFiles()[0].split("fct_sales")[0]
    for name, breakdown in BREAKDOWNS.items():
        assert folder not in plan(breakdown(held)._jdf.queryExecution(), "formatted"), name


def test_groupings_it_does_not_hold(make_fact):
    held = cube(make_fact({}), [("market",)])
    with pytest.raises(ValueError, match="order_region"):
        explore.late_rate_top_regions(held)
    with pytest.raises(ValueError, match="with orders"):
        explore.market_summary(held)
