import datetime as dt

from conftest import day

from revenue_lens.operators.cohorts import COHORTS, PERIODS, cohort_retention, cohort_retention_table

GOLDEN = [(1, "2024-01-05", 1), (1, "2024-01-20", 1), (1, "2024-03-02", 1), (2, "2024-01-31", 1), (2, "2024-02-01", 1), (3, "2024-02-10", 1)]


def test_retention_and_right_censoring(make_orders):
    cells = cohort_retention(make_orders(GOLDEN), day("2024-03-02")).collect()
    found = {(r["cohort"].month, r["period_index"]): (r["retention"], r["is_observable"]) for r in cells}
    assert found == {
        (1, 0): (1.0, True), (1, 1): (0.5, True), (1, 2): (0.5, True),
        (2, 0): (1.0, True), (2, 1): (0.0, True), (2, 2): (0.0, False),
    }
    assert {r["cohort"].month: r["cohort_size"] for r in cells} == {1: 2, 2: 1}


def test_thirteen_existing_periods_are_kept_by_position(make_orders):
    months = [*range(12), 14, 20]
    dates = [dt.date(2020 + m // 12, 1 + m % 12, 3).isoformat() for m in months]
    orders = make_orders([(1, d, 1) for d in dates])
    wide = cohort_retention_table(orders, day("2022-01-01"), COHORTS, PERIODS)
    assert wide.columns == ["cohort", *[f"m{i}" for i in range(12)], "m14"]
    assert list(wide.first())[1:] == [1.0] * 13
    assert cohort_retention_table(orders, day("2022-01-01")).columns == [*wide.columns, "m20"]


def test_all_cohorts_unless_asked_for_the_first(make_orders):
    rows = [(i, dt.date(2020 + i // 12, 1 + i % 12, 1).isoformat(), 1) for i in range(15)]
    for asked, shown in ((None, 15), (12, 12)):
        cells = cohort_retention(make_orders(rows), day("2021-12-01"), asked).collect()
        assert len({r["cohort"] for r in cells}) == shown


def test_orders_after_the_date_are_ignored(make_orders):
    cells = cohort_retention(make_orders(GOLDEN), day("2024-02-28")).collect()
    assert {r["period_index"] for r in cells} == {0, 1}
