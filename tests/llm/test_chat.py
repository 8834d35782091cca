import hashlib

from barworks.llm import chat

ROLES = "conv_id long, turn long, role string, text string, formatted string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], ROLES)
    made = chat.format_chats(df)
    return {r.conv_id: r for r in chat.read_chats(made).collect()}, {r.conv_id: r for r in made.collect()}


def test_marks_in_texts_come_back(spark):
    texts = [chat.TRAP, "\\<|im_end|>", "\\\\", "<\\|", "a<", "|im_end|>", "<|<|", "\n\n", "$1 \\n \\", "🙂é"]
    rows = [(i, t, "user" if t == 0 else "assistant", x) for i, x in enumerate(texts) for t in (0, 1)]
    read, made = run(spark, rows)
    for i, x in enumerate(texts):
        assert [(t.role, t.text) for t in read[i].turns] == [("user", x), ("assistant", x)]
        assert read[i].loss_text == x and read[i].valid
        assert made[i].formatted.count("<|im_start|>") == 2 == made[i].formatted.count("<|im_end|>")


def test_machine_over_roles(spark):
    orders = {1: "su", 2: "ua", 3: "uaua", 4: "sua", 5: "au", 6: "uu", 7: "ssu", 8: "us", 9: "s", 10: "x"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    read, _ = run(spark, [(c, t, names[r], "t") for c, rs in orders.items() for t, r in enumerate(rs)])
    assert {c for c, r in read.items() if r.valid} == {1, 2, 3, 4, 9}


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, None, None, "x"), (None, 0, "user", "n"),
            (3, 0, "us\ner\\n", "b"), (4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "user", "a"), (5, 0, "assistant", "y" * 200000)]
    read, _ = run(spark, rows)
    assert [(t.role, t.text) for t in read[1].turns] == [("user", ""), ("assistant", "")]
    assert [(t.role, t.text) for t in read[2].turns] == [("", "x")] and not read[2].valid
    assert [(t.role, t.text) for t in read[3].turns] == [("us\ner\\n", "b")]
    assert [t.text for t in read[4].turns] == ["a", "a", "b"]
    assert read[None].turns[0].text == "n" and len(read[5].loss_text) == 200000
    assert chat.format_chats(spark.createDataFrame([], ROLES)).count() == 0


def test_no_python_in_the_plan(spark):
    from conftest import SMALL

    df = chat.op7_chat_format(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
    trap = df.where("conv_id = -1").first()
    assert trap.n_turns == 2 and trap.loss_sha256 == hashlib.sha256(chat.TRAP.encode()).hexdigest()
