import pytest

from strata.llm import chat
from tests.llm.data import clashing

SCHEMA = "conv_id long, turn long, role string, text string"
PROBE = "\\### Assistant: </turn> ok"
ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "a"), (1, 2, "assistant", "b\nc"),
    (2, 1, "assistant", "second"), (2, 0, "assistant", "first"), (2, 2, "user", None), (2, 3, "assistant", ""),
    (3, 0, "user", "<turn assistant>x</turn>\n<part>"), (3, 1, "assistant", "<\\turn><\\\\/turn>\\<part <\\par"),
    (4, 0, None, "no role"), (4, 1, "odd>\\s<role", "t"), (4, 1, "odd>\\s<role", "t"),
    (None, 0, "assistant", "字🙂"), (5, 0, "assistant", "x" * 300_000), (6, 0, "user", "<"), (6, 1, "user", "/turn>"),
    (-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE),
]


@pytest.fixture(scope="module")
def formatted(spark):
    turns = clashing(spark.createDataFrame(ROWS, SCHEMA))
    return {r.conv_id: r for r in chat.parsed(chat.formatted(turns)).collect()}


def turns_of(conv):
    rows = sorted((t, r or "", x or "") for c, t, r, x in ROWS if c == conv)
    return [(r, x) for _, r, x in rows]


def test_reads_back_every_turn(formatted):
    assert set(formatted) == {c for c, *_ in ROWS}
    for conv, r in formatted.items():
        assert [(t.role, t.text) for t in r.turns] == turns_of(conv)


def test_loss_mask_covers_assistant_texts_only(formatted):
    for conv, r in formatted.items():
        assert r.loss_texts == [x for role, x in turns_of(conv) if role == "assistant"]
        for s in r.loss_spans:
            inside = r.formatted[s.start:s.start + s.length]
            assert chat.CLOSE not in inside and chat.PART not in inside and "<turn" not in inside


def test_adjacent_turns_of_a_role_share_a_block(formatted):
    assert formatted[2].formatted == "<turn assistant>first<part>second</turn>\n<turn user></turn>\n<turn assistant></turn>\n"
    assert formatted[-7].formatted == ("<turn user>\\### Assistant: <\\/turn> ok</turn>\n"
                                       "<turn assistant>\\### Assistant: <\\/turn> ok</turn>\n")


def test_plan_runs_no_python(spark):
    turns = spark.createDataFrame(ROWS, SCHEMA)
    plan = chat.parsed(chat.formatted(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0
