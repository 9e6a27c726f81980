import random

import pytest

from weirgate.llm import quotes

MESSAGES = "id string, scope string, sent bigint, body string"


def linked(spark, rows):
    out = quotes.conversations(spark.createDataFrame(rows, MESSAGES)).collect()
    return {r.id: (r.conversation_id, r.depth, r.parent, r.text) for r in out}


def test_nested_levels(spark):
    rows = [
        ("a", "l", 1, "How do I sort a table?\nIt is large."),
        ("b", "l", 2, "> How do I sort a table?\n> It is large.\n\nBy range."),
        ("c", "l", 3, ">> How do I sort a table?\n>> It is large.\n> By range.\nThanks!"),
        ("d", "l", 4, "> > By RANGE\n>  Thanks\n\nYou are welcome."),
        ("e", "l", 5, "> It is large.\nHow large?"),
        ("f", "l", 6, "> words nobody wrote\nalone"),
    ]
    assert linked(spark, rows) == {
        "a": ("a", 0, None, "How do I sort a table?\nIt is large."),
        "b": ("a", 1, "a", "By range."),
        "c": ("a", 2, "b", "Thanks!"),
        "d": ("a", 3, "c", "You are welcome."),
        "e": ("a", 1, "a", "How large?"),
        "f": ("f", 0, None, "alone"),
    }


def test_deeper_level_helps_when_the_parent_is_lost(spark):
    rows = [("a", "l", 1, "first words"), ("c", "l", 3, "> > first words\n> lost reply\nthird")]
    assert linked(spark, rows)["c"][:3] == ("a", 1, "a")


def test_scope_and_repeats(spark):
    rows = [("a", "l", 1, "same text"), ("b", "m", 1, "same text"), ("c", "m", 2, "> same text\nyes"), ("d", "l", 3, "same text"), ("e", "l", 4, "> same text\nno")]
    found = linked(spark, rows + rows[:2])
    assert found["c"][2] == "b" and found["e"][2] == "a" and len(found) == 5


def test_never_later_and_odd_rows(spark):
    rows = [
        ("a", None, 5, "> later words\nearly"), ("b", None, 6, "later words"), ("c", None, None, "> later words\nno time"),
        ("d", None, 7, None), ("e", None, 8, ""), ("f", None, 9, "> \n>\n"), (None, None, 9, "x"), ("g", None, 9, "> " * 50 + "deep\n" + "> later words"),
        ("h", None, 10, "> later words\n" + "long text " * 30_000),
    ]
    found = linked(spark, rows)
    assert {k: v[2] for k, v in found.items()} == {"a": None, "b": None, "c": None, "d": None, "e": None, "f": None, "g": "b", "h": "b", None: None}
    assert found["c"][3] == "no time" and found["d"][3] == "" and found["f"][3] == ""
    assert linked(spark, []) == {}


@pytest.mark.parametrize("length", [1, 2, 9, 40])
def test_long_chains(spark, length):
    rows = [(f"m{i}", "l", i, (f"> text {i - 1}\n" if i else "") + f"text {i}") for i in range(length)]
    assert {k: v[:2] for k, v in linked(spark, rows).items()} == {f"m{i}": ("m0", i) for i in range(length)}


def test_random_trees(spark):
    rng = random.Random(1)
    parents = {i: rng.randrange(i) if i and rng.random() < 0.9 else None for i in range(80)}
    rows = [(f"m{i}", "l", i, (f"> word{p} said\n" if p is not None else "") + f"word{i} said") for i, p in parents.items()]

    def top(i):
        return (i, 0) if parents[i] is None else (top(parents[i])[0], top(parents[i])[1] + 1)

    found = linked(spark, rows)
    assert {k: v[:2] for k, v in found.items()} == {f"m{i}": (f"m{top(i)[0]}", top(i)[1]) for i in parents}


def test_output_is_in_reply_order(spark):
    rows = [(f"m{i}", "l", i, (f"> text {i - 2}\n" if i > 1 else "") + f"text {i}") for i in range(30)]
    out = quotes.conversations(spark.createDataFrame(rows, MESSAGES)).select("conversation_id", "depth").collect()
    assert out == sorted(out)


def test_repeated_and_nameless_messages_and_extra_columns(spark):
    schema = "id string, scope string, sent bigint, body string, level int, lines string, own string, root string, p int"
    rows = [
        ("a", "s", 2, "later text of a"), ("a", "s", 1, "first words here"), ("a", "s", 1, "zzz other words"),
        ("b", "s", 3, "> first words here\n\nreply to a"), (None, "s", 0, "first words here"), (None, "s", 0, "first words here"),
    ]
    out = quotes.conversations(spark.createDataFrame([(*r, 1, "l", "o", "r", 2) for r in rows], schema)).collect()
    said = sorted((r.id or "", r.conversation_id or "", r.depth, r.parent or "", r.text) for r in out)
    nameless = ("", "", 0, "", "first words here")
    assert said == [nameless, nameless, ("a", "a", 0, "", "first words here"), ("b", "a", 1, "a", "reply to a")]
