import pytest

from coinslot.operators import quality as q

RULE = "unit_price > 0 OR channel_code = 'membership_included'"


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            ("a", 59.99, 0.1, "digital_store"),
            ("b", -1.0, 0.0, "digital_store"),
            ("c", 0.0, None, "membership_included"),
        ],
        "event_id string, unit_price double, discount_pct double, channel_code string",
    )


def ids(df):
    return sorted(r.event_id for r in df.collect())


def test_drop_removes_and_quarantines(spark, events, folder):
    kept = q.run_expectations(events, [q.Expectation("price_positive", RULE, "drop")], folder)
    assert ids(kept) == ["a", "c"] and kept.columns == events.columns
    bad = spark.read.parquet(folder).collect()
    assert [(r.event_id, r._dq_failed_rules) for r in bad] == [("b", ["price_positive"])]


def test_fail_raises_after_quarantining(spark, events, folder):
    with pytest.raises(ValueError, match="Hard data-quality expectation breached"):
        q.run_expectations(events, [q.Expectation("price_positive", "unit_price > 0", "fail")], folder)
    assert ids(spark.read.parquet(folder)) == ["b", "c"]


def test_fail_policy_hardens_a_warn_rule(events, folder):
    rules = [q.Expectation("price_positive", RULE, "warn")]
    assert ids(q.run_expectations(events, rules, folder + "/warn", policy="warn")) == ["a", "b", "c"]
    with pytest.raises(q.QualityError):
        q.run_expectations(events, rules, folder + "/fail", policy="fail")


def test_policy_cannot_loosen_a_rule(events, folder):
    with pytest.raises(q.QualityError):
        q.run_expectations(events, [q.Expectation("p", RULE, "fail")], folder, policy="warn")


def test_drop_policy_drops_warn_failures(events):
    rules = [q.Expectation("p", RULE, "warn")]
    assert ids(q.apply_expectations(events, rules, "drop").valid) == ["a", "c"]


def test_one_drop_rule_arms_all_in_reference_mode_only(events):
    rules = [q.Expectation("p", "event_id <> 'a'", "drop"), q.Expectation("w", "event_id <> 'b'", "warn")]
    assert ids(q.apply_expectations(events, rules).valid) == ["c"]
    assert ids(q.apply_expectations(events, rules, mode="per_rule").valid) == ["b", "c"]


def test_null_condition_passes(spark):
    df = spark.createDataFrame([("a", None)], "event_id string, v int")
    assert ids(q.apply_expectations(df, [q.Expectation("v", "v > 0", "drop")]).valid) == ["a"]


def test_row_failing_two_rules_lists_both(events):
    rules = [q.Expectation("one", "event_id <> 'b'", "warn"), q.Expectation("two", "unit_price > 0", "warn")]
    result = q.apply_expectations(events, rules)
    assert {r.event_id: r._dq_failed_rules for r in result.quarantine.collect()} == {"b": ["one", "two"], "c": ["two"]}
    assert {r.rule: r.failures for r in q.rule_counts(result, rules).collect()} == {"one": 1, "two": 2}


def test_rerun_does_not_double_the_quarantine(spark, events, folder):
    rules = [q.Expectation("p", RULE, "drop")]
    for _ in range(2):
        q.run_expectations(events, rules, folder, run_id="7")
    assert spark.read.parquet(folder).count() == 1


def test_empty_tables(events):
    assert [r[0] for r in q.empty_tables({"full": events, "none": events.filter("false")}).collect()] == ["none"]


def test_contract_rules_parse(spark):
    sales = spark.createDataFrame(
        [("t", "PS", 1995, -1.0, 1.0, 0.0, 0.0, 0.0), ("", "PS", 1980, 1.0, 1.0, 0.0, 0.0, 0.0)],
        "title string, platform_code string, release_year int, global_sales_musd double, na_sales double, "
        "eu_sales double, jp_sales double, other_sales double",
    )
    bad = q.apply_expectations(sales, q.sales_rules()).quarantine.collect()
    assert sorted(r._dq_failed_rules for r in bad) == [
        ["game_title_not_null", "year_plausible"], ["sales_non_negative", "regions_sum_matches"],
    ]
