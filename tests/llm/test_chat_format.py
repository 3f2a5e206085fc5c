"""Chat formatting: round trips, turn spans, rewriting templates, long conversations."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.llm import chat_format as C
from llm_cases import rows

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, block string"
nasty = st.lists(st.sampled_from(["\\", "###", "### ", "</turn>", "</turn>\n", "\n", ": ", "a", "<", "é", "assistant"]),
                 max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(nasty, nasty), max_size=4))
def test_round_trip(turns):
    output = C.render(turns)
    assert [(r, t) for r, t, _, _ in C.parse(output)] == turns
    added, rewrites = C.locate(C.render, [], turns)
    assert "".join(added) == output and not rewrites
    assert [C.parse(a)[0][:2] for a in added] == turns


def test_template_that_rewrites_history():
    forgetful = lambda turns: "".join(f"[{r}]{t if i > len(turns) - 3 else '...'}" for i, (r, t) in enumerate(turns))
    assert C.locate(forgetful, [], [("u", "a"), ("a", "b"), ("u", "c")])[1]
    counted = lambda turns: f"{len(turns)}:" + C.render(turns)
    assert C.locate(counted, [], [("u", "a"), ("a", "b")])[1]
    assert not C.locate(C.render, [("u", "z")], [("u", "a"), ("a", "b")])[1]


def digest(turns):
    h = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), h, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(C.render(turns))


def check(spark, df):
    want = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.conv_id), r.turn is not None, r.turn or 0, r.role or "", r.text or "")):
        want.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    found = {r[0]: r[1:] for r in rows(C.digests(C.format_conversations(df)))}
    assert found == {k: (*digest(v), False) for k, v in want.items()}


def test_driver_table(spark):
    df = C.with_probe(spark, spark.read.parquet(f"{SF}/conversations.parquet"))
    check(spark, df)
    probe = [r for r in rows(C.digests(C.format_conversations(df))) if r[0] == C.PROBE_ID]
    assert probe[0][1] == 2 and probe[0][3] == len(C.PROBE_TEXT)


@pytest.mark.parametrize("n", [1, 31, 32, 33, 64, 500])
def test_long_conversations_and_odd_rows(spark, n):
    data = [(1, i, "assistant" if i % 2 else "user", f"t{i} </turn> \\", "x") for i in range(n)]
    data += [(2, None, None, None, None), (2, 0, "assistant", "", "x"), (2, 0, "assistant", "same", "x"), (2, 0, "assistant", "same", "x"),
             (None, 1, "user", "no id", "x"), (-3, 5, "assistant", "w " * 30_000, "x")]
    check(spark, spark.createDataFrame(data, SCHEMA))


def test_empty(spark):
    assert rows(C.digests(C.format_conversations(spark.createDataFrame([], SCHEMA)))) == []


def test_spans_of_the_output(spark):
    df = spark.createDataFrame([(5, i, "user", f"x{i}", "b") for i in range(70)], SCHEMA)
    blocks = sorted(C.format_conversations(df).collect(), key=lambda r: r.block)
    assert [len(b.roles) for b in blocks] == [32, 32, 6] and [b.last for b in blocks] == [False, False, True]
    texts = [C.parse(b.output[s:e])[0][1] for b in blocks for s, e in zip(b.starts, b.ends)]
    assert texts == [f"x{i}" for i in range(70)]


def test_templates_that_look_far_back(spark):
    turns = [("user" if i % 2 == 0 else "assistant", f"x{i}") for i in range(90)]
    df = spark.createDataFrame([(5, i, r, t, "b") for i, (r, t) in enumerate(turns)], SCHEMA)

    def numbered(given):
        return "".join(f"{i}:{t}\n" for i, (_, t) in enumerate(given))

    def dropping(given):        # old turns go once there are more than 40
        return "".join(f"{t}\n" for _, t in given[-40:])

    def repeated(given):        # the first turn again after each
        return "".join(f"{given[0][1]}|{t}\n" for _, t in given)

    for template, rewrites in ((numbered, False), (dropping, True), (repeated, False)):
        blocks = sorted(C.format_conversations(df, template).collect(), key=lambda r: r.block)
        assert any(b.rewrites for b in blocks) == rewrites
        if not rewrites:
            assert "".join(b.output for b in blocks) == template(turns)
        else:
            assert [b.rewrites for b in blocks] == [False, True, True]
