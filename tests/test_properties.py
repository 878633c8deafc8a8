"""Properties of batches and lines that must hold for any input."""

from datetime import date, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st

from closebook.operators import journal as j

LINES = st.lists(
    st.tuples(
        st.sampled_from([date(2024, 1, 1), date(2024, 2, 1)]),
        st.integers(0, 6),
        st.integers(0, 3),
        st.sampled_from([1, 2, 92, 9999, None]),
        st.sampled_from(["AmEx", "Bank", "Shop", None]),
        st.integers(-300, 300),
    ),
    max_size=60,
)
SCHEMA = (
    "reportmonth date, organization_id bigint, payment_date date, sku bigint, partner_type string, amount decimal(33,2)"
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=LINES, size=st.integers(1, 7))
def test_batches(spark, rows, size):
    lines = spark.createDataFrame(
        [(m, org, m + timedelta(days=d), sku, p, Decimal(cents) / 100) for m, org, d, sku, p, cents in rows], SCHEMA
    )
    expected = {}
    for m, org, d, sku, partner, cents in rows:
        if partner is not None and sku in (1, 2):
            key = (m, org, m + timedelta(days=d), "AmEx" if partner == "AmEx" else "Non-AmEx", sku)
            expected[key] = expected.get(key, 0) + cents
    stage = j.stage_batches(j.billed_amounts(lines), size, per_month=True)
    staged = stage.collect()
    found = {(r.report_month, r.organization_id, r.payment_date, r.partner, r.sku): int(r.amount * 100) for r in staged}
    assert found == {key: cents for key, cents in expected.items() if cents}
    assert len(found) == len(staged)

    files = {}
    for r in staged:
        files.setdefault((r.report_month, r.file_no), []).append(r)
    for month in {m for m, _ in files}:
        numbers = sorted(n for m, n in files if m == month)
        assert numbers == list(range(1, len(numbers) + 1))
        partners = [files[month, n][0].partner for n in numbers]
        assert partners == sorted(partners)
    for batch in files.values():
        assert len(batch) <= size
        assert len({r.partner for r in batch}) == 1

    products = spark.createDataFrame(
        [(1, "one", "40001", "Subscription Revenue", "SKU100 - one")],
        "sku bigint, sku_product_description string, netsuite_gl_account_number string, product_group string, netsuite_sku string",
    )
    balance = j.reconcile(j.journal_lines(stage, products)).collect()
    assert {(r.report_month, r.file_no): r.n_lines for r in balance} == {k: len(v) + 1 for k, v in files.items()}
    assert all(r.delta == 0 for r in balance)
    totals = {(r.report_month, r.file_no): r.debit for r in balance}
    assert totals == {k: sum(r.amount for r in v) for k, v in files.items()}
