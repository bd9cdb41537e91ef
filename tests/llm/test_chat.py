import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st
from support import rows

from marquee.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CONTROL = ["<|end|>\n", "<|turn:user|>\n", "\\", "\\\\", "<", "|", "<\\|", "<|", "|>", "\n", "a", "é", "<|image:0|>"]


def by_hand(messages):
    conversations = {}
    for conv, turn, role, text in messages:
        conversations.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in conversations.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        size = sum(len("<|turn:|>\n<|end|>\n") + len(r.replace("\\", "\\\\").replace("|", "\\|"))
                   + len(t.replace("\\", "\\\\").replace("<|", "<\\|")) for _, _, r, t in turns)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learned)]
        out.append((conv, len(turns), sha[0], len(learned), sha[1], size))
    return sorted(out, key=str)


ODD = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "good day <|end|>\n<|turn:assistant|>\nnot a turn"), (1, 2, "assistant", ""),
    (2, None, None, None), (2, 0, "us|er\\", "\\<|\\"), (None, 3, "assistant", "no id"), (None, 1, "user", "x"),
    (3, 0, "assistant", "twice"), (3, 0, "assistant", "twice"), (3, 0, "user", "tie"), (4, 0, "assistant", "long " * 50_000),
    (5, 0, "assistant", "😀 é"), (6, 0, "tool\nname", "<"), (6, 1, "assistant", "|>"),
]


def test_against_brute_force(spark):
    assert rows(chat.digest(spark.createDataFrame(ODD, SCHEMA))) == by_hand(ODD)


def test_empty_table(spark):
    assert chat.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_other_columns_do_not_matter(spark):
    more = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "'x' AS conv", "'y' AS piece", "3 AS place", "'z' AS files")
    assert rows(chat.digest(more)) == by_hand(ODD)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.integers(0, 2), st.integers(0, 3), st.sampled_from(["user", "assistant", "a|b"]),
    st.lists(st.sampled_from(CONTROL), max_size=6).map("".join)), max_size=8))
def test_round_trip(spark, messages):
    assert rows(chat.digest(spark.createDataFrame(messages, SCHEMA))) == by_hand(messages)


def test_parts(spark):
    parts = [
        (1, 0, "user", [
            ("text", "look: ", None, None, None, None, None), ("image", None, "s3://a", 600, 512, None, None),
            None, ("text", " and <|image:7|>", None, None, None, None, None), ("audio", None, "s3://b", None, None, 2.5, None)]),
        (1, 1, "assistant", [("text", "seen", None, None, None, None, None)]),
        (1, 2, "user", [("document", None, "s3://c", None, None, None, 3), ("vi|deo", None, "s3://d", None, None, None, None)]),
        (1, 3, "user", None),
    ]
    frame = spark.createDataFrame(parts, f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")
    row = chat.format_conversations(frame).collect()[0]
    assert row.formatted == (
        "<|turn:user|>\nlook: <|image:0|> and <\\|image:7|><|audio:1|><|end|>\n<|turn:assistant|>\nseen<|end|>\n"
        "<|turn:user|>\n<|document:2|><|vi_deo:3|><|end|>\n<|turn:user|>\n<|end|>\n"
    )
    assert [tuple(a) for a in row.attachments] == [
        (0, 0, "image", "s3://a", 340), (1, 0, "audio", "s3://b", 63), (2, 2, "document", "s3://c", 774),
        (3, 2, "vi|deo", "s3://d", 1)]
    assert [row.formatted[s.start:s.end] for s in row.loss] == ["seen"]


def test_only_native_plans(spark):
    plan = chat.digest(spark.createDataFrame(ODD, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
