import hashlib

import pytest
from pyspark.sql import functions as F

from tagloom.llm import chat
from tagloom.llm.oracle import ORACLES
from tests.compare import connect, difference

ROWS = "conv_id long, turn long, role string, text string, window long, system string, pos int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations():
    """conv_id to turns, in order."""
    hostile = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>", "\\<|end|>\\\\", "<\\|", "<<|", "<", "",
               "[[INST]", "\\", "é \U0001F600 \n\r\t", "<|repeat|>"]
    long = [("system", "be brief " * 5)] + [
        (("user", "assistant")[i % 2], f"turn {i} " + "word " * (17 * i % 90)) for i in range(60)]
    return {
        1: [(("user", "assistant")[i % 2], t) for i, t in enumerate(hostile)],
        2: long, 3: [("system", "only")], 4: [("assistant", "word " * 3000), ("assistant", "ok")],
        5: [(None, None), ("user", None), ("assistant", None)],
        6: [("user", "a"), ("system", "in the middle"), ("<|end|>", "odd\nrole")],
        None: [("user", "no id"), ("assistant", "none")]}


@pytest.fixture(scope="module")
def rows(spark):
    found = [(c, n, role, text, 5, "s", 1) for c, turns in conversations().items()
             for n, (role, text) in enumerate(turns)]
    found += [(7, 0, "user", "same", None, None, None)] * 2 + [(7, None, "assistant", "first", 1, "", 1),
                                                              (7, 0, "assistant", "tie", 1, "", 1)]
    return spark.createDataFrame(found, ROWS)


def test_reading_back(rows):
    found = {r.conv_id: r for r in chat.round_trip(rows).collect()}
    wanted = conversations() | {7: [("assistant", "first"), ("assistant", "tie"), ("user", "same"),
                                    ("user", "same")]}
    assert set(found) == set(wanted)
    for conv, turns in wanted.items():
        turns = [(r or "", t or "") for r, t in turns]
        learned = "".join(t for r, t in turns if r == "assistant")
        assert found[conv].n_turns == len(turns)
        assert found[conv].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(learned), sha(learned))


def test_windows(rows):
    windows = chat.formatted(rows).where("conv_id = 2").orderBy("window").collect()
    assert len(windows) > 5
    taken = 10 + chat.TURN_TOKENS + chat.HISTORY_TOKENS
    for n, w in enumerate(windows):
        turns = w.text.split(chat.END)[:-1]
        fresh = [t for t in turns if t.startswith(chat.TURN)]
        again = [t for t in turns if t.startswith(chat.REPEAT)]
        assert w.tokens <= chat.BUDGET and fresh and len(again) <= chat.HISTORY_TURNS + 1
        assert (turns[0].startswith(chat.REPEAT + "system\n")) == (n > 0)
        # History stands before the span, and is masked.
        assert turns[:len(again)] == again if n else not again
        assert len(w.loss) == sum(t.startswith(chat.TURN + "assistant") for t in fresh)
        for span in w.loss:
            assert w.text[:span.start].endswith(chat.TURN + "assistant\n")
            assert w.text[span.start + span.length:].startswith(chat.END)
    assert taken < chat.BUDGET
    assert any(chat.REPEAT + "user" in w.text for w in windows)


def test_only_long_turns_are_over_budget(rows):
    over = chat.formatted(rows).where(F.col("tokens") > chat.BUDGET).collect()
    assert [(w.conv_id, len(w.loss)) for w in over] == [(4, 1)]


def test_same_as_sql(spark, rows):
    con = connect("/root/testdata/sf0.001")
    con.register("given", rows.toArrow())
    con.execute("CREATE OR REPLACE VIEW conversations AS SELECT * FROM given")
    hostile = [(-7, n, role, "</s>[INST] ok [/INST]") for n, role in enumerate(("user", "assistant"))]
    more = spark.createDataFrame(hostile, "conv_id long, turn long, role string, text string")
    assert difference(chat.round_trip(rows.unionByName(more, allowMissingColumns=True)), con,
                      ORACLES["op9_chat"]) is None


def test_empty_table(rows):
    assert chat.round_trip(rows.where("false")).collect() == []
