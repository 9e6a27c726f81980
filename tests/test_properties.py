"""Random batches against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from weirgate.operators.rules import between, evaluate, in_set, not_null
from weirgate.operators.split import bad_rows, batch_counts, good_rows, is_bad, limbo_rows
from weirgate.operators.summary import validation_gate, violation_counts
from weirgate.operators.upsert import KeyedTable, insert_new, read_table
from weirgate.session import scratch_path

RELAXED = {"deadline": None, "suppress_health_check": [HealthCheck.function_scoped_fixture]}
TYPES = "day string, id int, amount int"
DAYS = [None, "2024-01-05", "2024-02-05", "no day"]
rows = st.lists(st.tuples(st.sampled_from(DAYS), st.sampled_from([None, 1, 2, 3]), st.integers(0, 3)), max_size=8)


def expected_insert(table, batch, null_safe):
    """Insert-only: rows whose key is not in the table before the batch."""

    def known(row):
        key = row[:2]
        return key in {r[:2] for r in table} and (null_safe or None not in key)

    return table + [row for row in batch if not known(row)]


@settings(max_examples=6, **RELAXED)
@given(st.lists(rows, min_size=1, max_size=3), st.booleans())
def test_inserts(spark, batches, null_safe):
    table = KeyedTable(scratch_path(spark, "table"), ("day", "id"), "day")
    staging, expected = scratch_path(spark, "staging"), []
    for number, batch in enumerate(batches):
        before = len(expected)
        expected = expected_insert(expected, batch, null_safe)
        frame = spark.createDataFrame(batch, TYPES)
        new = insert_new(spark, frame, table, staging, f"b{number}", null_safe_keys=null_safe)
        assert new.n_new == len(expected) - before
        stored = [tuple(r) for r in read_table(spark, table, frame.schema).collect()]
        assert sorted(stored, key=repr) == sorted(expected, key=repr)


def violations(row):
    """The three rules on one row: true, false or None each."""
    a, b = row
    return [None if a is None else a not in ("x", "y"), None if b is None else not 1 <= b <= 3, b is None]


@settings(max_examples=8, **RELAXED)
@given(st.lists(st.tuples(st.sampled_from([None, "x", "y", "z"]), st.sampled_from([None, 0, 1, 3, 4])), max_size=12))
def test_split_gate_and_summary(spark, values):
    rules = [in_set("a", ["x", "y"]), between("b", 1, 3), not_null("b")]
    flagged = evaluate(spark.createDataFrame(values, "a string, b int"), rules).cache()
    flags = [violations(v) for v in values]
    bad = [any(f is True for f in fs) for fs in flags]
    unknown = [not b and None in fs for b, fs in zip(bad, flags)]

    def as_rows(frame):
        return sorted((tuple(r) for r in frame.collect()), key=repr)

    def pick(chosen):
        return sorted((v for v, c in zip(values, chosen) if c), key=repr)

    for policy, bad_too, good_too in (("pass", False, True), ("fail", True, False), ("drop", False, False)):
        assert as_rows(bad_rows(flagged, rules, policy)) == pick([b or (u and bad_too) for b, u in zip(bad, unknown)])
        good = [not b and (not u or good_too) for b, u in zip(bad, unknown)]
        assert as_rows(good_rows(flagged, rules, policy)) == pick(good)
        assert batch_counts(flagged, rules, policy).first()["n_good"] == sum(good)
    assert as_rows(limbo_rows(flagged, rules)) == pick(unknown)
    assert as_rows(flagged.where(is_bad(rules)).select("a", "b")) == pick(bad)
    counts = violation_counts(flagged, rules).collect()
    assert [r["unexpected_count"] for r in counts] == [sum(fs[i] is True for fs in flags) for i in range(3)]
    assert validation_gate(flagged, rules).first()["success"] is (not any(bad))
    flagged.unpersist()
