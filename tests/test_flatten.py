import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.flatten import blank_empty, find_leaves, flatten


def frame(spark, *records):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)], "id int, j string")


def flat(spark, *records, **options):
    out = flatten(frame(spark, *records), "j", **options).orderBy("id").collect()
    return [{k: v for k, v in r.asDict().items() if k != "id" and v is not None} for r in out]


def test_falsy_values_are_leaves(spark):
    record = {"a": {"zero": 0, "no": False, "empty": "", "none": None, "obj": {}, "list": []}}
    assert flat(spark, record) == [{"a_zero": "0", "a_no": "false", "a_empty": "", "a_obj": "{}", "a_list": "[]"}]
    assert "a_none" in flatten(frame(spark, record), "j").columns


def test_empty_containers_can_be_blank(spark, rows):
    assert flat(spark, {"a": {}, "b": [], "c": "{}"}, empty_as="") == [{"a": "", "b": "", "c": "{}"}]
    df = spark.createDataFrame([("{}", "[]", "x")], "a string, b string, c string")
    assert rows(blank_empty(df)) == [("", "", "x")]


def test_lists_use_their_index(spark):
    assert flat(spark, {"l": [1, {"x": [2, 3]}]}, {"l": []}) == [{"l_0": "1", "l_1_x_0": "2", "l_1_x_1": "3"}, {"l": "[]"}]


def test_records_with_different_keys_share_a_table(spark):
    assert flat(spark, {"a": 1}, {"b": {"c": 2}}, {"b": 3}) == [{"a": "1"}, {"b_c": "2"}, {"b": "3"}]


@pytest.mark.parametrize(
    "record, winner",
    [('{"a_b":1,"a":{"b":2}}', "2"), ('{"a":{"b":2},"a_b":1}', "1"), ('{"a":{"b_c":1,"b":{"c":2}}}', "2")],
)
def test_on_a_name_clash_the_later_value_wins(spark, record, winner):
    (got,) = flat(spark, record)
    assert list(got.values()) == [winner]


def test_only_top_level_text_is_embedded(spark):
    records = [
        {"p": '{"x": {"y": 1}}', "q": {"r": '{"z": 1}'}, "n": "5", "l": "[1]"},
        {"p": "plain"},
        {"p": {"x": {"y": 7}}},
        {"p": "{}"},
    ]
    assert flat(spark, *records, embedded=True) == [
        {"p_x_y": "1", "q_r": '{"z": 1}', "n": "5", "l": "[1]"},
        {"p": "plain"},
        {"p_x_y": "7"},
        {"p": "{}"},
    ]


def test_cleaning_happens_before_embedded_text_is_parsed(spark):
    record = {"t": "a\nb  c", "p": '{"x": "k  l\\nm"}', "k  ey": "v"}
    assert flat(spark, record, embedded=True, clean=True) == [{"t": "a b c", "p_x": "k l\nm", "k  ey": "v"}]


def test_separator_options(spark):
    record = {"a_b": {"c": 1}, "skip": {"d": 2}, "e": {"skip": 3}}
    assert flat(spark, record, separator=".", replace_separators="-", ignore_root_keys=["skip"]) == [{"a_b.c": "1", "e.skip": "3"}]
    assert flat(spark, {"a_b": {"c_d": 1}}, replace_separators="-") == [{"a-b_c-d": "1"}]


def test_deep_records_are_followed(spark):
    record = leaf = {}
    for level in range(11):
        leaf["k"] = {}
        leaf = leaf["k"]
    leaf["end"] = 1
    assert flat(spark, record) == [{"_".join(["k"] * 11 + ["end"]): "1"}]


def test_keys_with_quotes_and_dots(spark):
    assert flat(spark, {"it's": 1, "a.b": {"[0]": 2}}) == [{"it's": "1", "a.b_[0]": "2"}]


def test_known_leaves_skip_the_search(spark):
    leaves = find_leaves(frame(spark, {"a": {"b": 1}}), "j")
    out = flatten(frame(spark, {"a": {"b": 5, "new": 6}}), "j", leaves)
    assert [r.asDict() for r in out.collect()] == [{"id": 0, "a_b": "5"}]


def test_flattening_needs_no_shuffle(spark):
    df = frame(spark, {"a": {"b": 1}, "l": [1, 2]})
    out = flatten(df, "j", find_leaves(df, "j"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_too_many_columns_is_an_error(spark):
    with pytest.raises(ValueError, match="max_columns"):
        find_leaves(frame(spark, {str(i): i for i in range(9)}), "j", max_columns=5)


def test_unreadable_json_is_an_error_or_null(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        flatten(frame(spark, "{oops", {"a": 1}), "j").collect()
    assert flat(spark, "{oops", {"a": 1}, strict=False) == [{}, {"a": "1"}]


def test_variant_input(spark):
    df = frame(spark, {"a": [{"b": 1}]}).withColumn("j", F.parse_json("j"))
    assert flatten(df, "j").first().a_0_b == "1"


def brute(value, name=()):
    if not value or not isinstance(value, (dict, list)):
        return {"_".join(name): value}
    out = {}
    for key, child in value.items() if isinstance(value, dict) else enumerate(value):
        out.update(brute(child, (*name, str(key))))
    return out


KEYS = st.text(alphabet="ab_", min_size=1, max_size=3)
LEAVES = st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from(["", "x", "{}", "[]"])
VALUES = st.recursive(LEAVES, lambda v: st.lists(v, max_size=3) | st.dictionaries(KEYS, v, max_size=3), max_leaves=8)
RECORDS = st.lists(st.dictionaries(KEYS, VALUES, min_size=1, max_size=3), min_size=1, max_size=4)


def rendered(value):
    if value is None:
        return None
    return value if isinstance(value, str) else json.dumps(value)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(RECORDS)
def test_agrees_with_brute_force(spark, records):
    wanted = [{k: rendered(v) for k, v in brute(r).items() if v is not None} for r in records]
    assert flat(spark, *records) == wanted
