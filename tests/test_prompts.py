"""Prompt and chat formats: goldens and made-up items."""

from pyspark.sql import functions as F

from quarry.operators import prompts

# The two multiple-choice questions and, below, the chat messages
# whose formatted text is known.
Q1 = "Find the degree for the given field extension Q(sqrt(2), sqrt(3), sqrt(18)) over Q."
Q2 = "Let p = (1, 2, 5, 4)(2, 3) in S_5 . Find the index of <p> in S_5."


def test_format_mmlu_golden(spark):
    mc = spark.createDataFrame([(0, Q1, ["0", "4", "2", "6"], 1), (1, Q2, ["8", "2", "24", "120"], 2)],
                               "item_id long, question string, choices array<string>, answer int")
    rows = {r.item_id: r for r in prompts.format_mmlu(mc).collect()}
    assert rows[0].prompt == f"Question: {Q1}\nA. 0\nB. 4\nC. 2\nD. 6\nAnswer:"
    assert rows[0].label == "B"
    assert rows[1].prompt == f"Question: {Q2}\nA. 8\nB. 2\nC. 24\nD. 120\nAnswer:"
    assert rows[1].label == "C"


def test_mmlu_edge_cases(spark):
    mc = spark.createDataFrame([(0, "q", ["a", "b", "c", "d", "e"], 4), (1, "q", ["a", "b", "c"], 2)],
                               "item_id long, question string, choices array<string>, answer int")
    rows = {r.item_id: r for r in prompts.format_mmlu(mc).collect()}
    assert rows[0].prompt is None and rows[0].label is None
    assert rows[1].prompt == "Question: q\nA. a\nB. b\nC. c\nAnswer:" and rows[1].label == "C"


GSM = [
    ("A shelf holds nine jars and three break. How many are left?", "9 - 3 = 6\n#### 6"),
    ("Two boats carry four people each. How many people?", "2 * 4 = 8\n#### 8"),
    ("A rope of 12 m is cut into 4 parts. How long is one?", "12 / 4 = 3\n#### 3"),
    ("A train has 5 cars of 40 seats. How many seats?", "5 * 40\n#### 200"),
]


def test_gsm8k_and_few_shot_golden(spark):
    wa = spark.createDataFrame([(i, q, a) for i, (q, a) in enumerate(GSM)],
                               "item_id long, question string, answer string")
    f = prompts.format_gsm8k(wa)
    answers = {r.item_id: r.answer for r in f.collect()}
    assert answers[0] == "6" and answers[1] == "8"
    items = f.withColumnRenamed("answer", "label")
    shot = prompts.few_shot(items, 3).collect()
    assert len(shot) == 1 and shot[0].item_id == 3
    want = "".join(f"Question: {q}\nAnswer: {a.split('#### ')[1]}\n\n" for q, a in GSM[:3])
    assert shot[0].prompt == want + f"Question: {GSM[3][0]}\nAnswer:"


def test_extract_answer_edges(spark):
    df = spark.createDataFrame([("no marker",), ("#### 1\n#### 2",), ("####\n7",), ("#### ",)], "s string")
    got = [r.a for r in df.select(prompts.extract_answer(F.col("s")).alias("a")).collect()]
    assert got == [None, "1", "7", ""]


MESSAGES = [(0, 0, "system", "You are a helpful assistant."),
            (0, 1, "user", "Hello, how can I use chat templates?"),
            (0, 2, "assistant", "You can use the apply_chat_template method!"),
            (0, 3, "user", "Show me an example.")]


def conv(spark):
    return spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string")


def test_chat_custom_golden(spark):
    got = prompts.chat_custom(conv(spark)).first()["text"]
    assert got == ("### System: You are a helpful assistant.\n"
                   "### User: Hello, how can I use chat templates?\n"
                   "### Assistant: You can use the apply_chat_template method!\n"
                   "### User: Show me an example.\n### Assistant: ")


def test_format_roles_system_is_assistant(spark):
    got = prompts.format_roles(conv(spark)).first()["text"]
    assert got.startswith("### Assistant: You are a helpful assistant.\n### Human: Hello")


def test_chatml(spark):
    got = prompts.chat_chatml(conv(spark)).first()["text"]
    assert got.startswith("<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n")
    assert got.endswith("<|im_start|>user\nShow me an example.<|im_end|>\n<|im_start|>assistant\n")


def test_instruction_input_empty_or_null(spark):
    df = spark.createDataFrame([("do x", None, "ok"), ("do y", "", "ok"), ("do z", "ctx", "ok")],
                               "instruction string, input string, output string")
    got = [r.t for r in df.select(prompts.instruction_text(
        F.col("instruction"), F.col("input"), F.col("output")).alias("t")).collect()]
    assert got[0] == "### Instruction:\ndo x\n\n### Response:\nok"
    assert got[1] == "### Instruction:\ndo y\n\n### Response:\nok"
    assert got[2] == "### Instruction:\ndo z\n\n### Input:\nctx\n\n### Response:\nok"


def test_missing_role_keeps_its_turn(spark):
    df = spark.createDataFrame([(0, 0, None, "first"), (0, 1, "user", None)], "conv_id long, turn long, role string, text string")
    assert prompts.chat_chatml(df, False).first()["text"] == "<|im_start|>\nfirst<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert prompts.chat_custom(df, False).first()["text"] == "### : first\n### User: \n"


def test_messages_arrays_equal_turn_tables(spark):
    arrays = prompts.conversation_messages(conv(spark))
    got = arrays.select(prompts.messages_text(F.col("messages")).alias("a"),
                        prompts.messages_text(F.col("messages"), prompts.line_custom, "### Assistant: ").alias("b"),
                        prompts.messages_text(F.col("messages"), prompts.line_roles, "").alias("c")).first()
    assert got.a == prompts.chat_chatml(conv(spark)).first()["text"]
    assert got.b == prompts.chat_custom(conv(spark)).first()["text"]
    assert got.c == prompts.format_roles(conv(spark)).first()["text"]
    plan = arrays.select(prompts.messages_text(F.col("messages")))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") <= 1  # the grouping into arrays alone


def test_few_shot_keeps_null_groups(spark):
    items = spark.createDataFrame([(i, None if i % 2 else "s", f"p{i}", "l") for i in range(8)], "item_id long, subject string, prompt string, label string")
    got = {r.item_id: r.prompt for r in prompts.few_shot(items, 2, "subject").collect()}
    assert got[5] == "p1 l\n\np3 l\n\np5" and sorted(got) == [4, 5, 6, 7]


def test_label_goes_with_the_prompt(spark):
    mc = spark.createDataFrame([(0, "q", ["a", "b", "c", "d", "e"], 2)], "item_id long, question string, choices array<string>, answer int")
    r = prompts.format_mmlu(mc).first()
    assert r.prompt is None and r.label is None


def test_rows_without_keys(spark):
    """A conversation without an id pairs its turns; an item without a key gets a prompt and is no example."""
    conv = spark.createDataFrame([(None, 1, "user", "q"), (None, 2, "assistant", "a"), (1, 1, "user", "x"), (1, None, "assistant", "y"), (1, None, "user", "z"), (None, None, "system", "s")],
                                 "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in prompts.instruction_rows(conv).select("conv_id", "turn", "instruction", "output", "input").collect()]
    assert got == [(None, 1, "q", "a", "s")]
    items = spark.createDataFrame([(1, "p1", "l1"), (2, "p2", "l2"), (None, "p", "l"), (3, "p3", "l3")], "item_id long, prompt string, label string")
    assert sorted((repr(r.item_id), r.prompt) for r in prompts.few_shot(items, 2).collect()) == [("3", "p1 l1\n\np2 l2\n\np3"), ("None", "p1 l1\n\np2 l2\n\np")]
    alone = spark.createDataFrame([(None, "p", "l")], "item_id long, prompt string, label string")
    assert [r.prompt for r in prompts.few_shot(alone, 2).collect()] == ["p"]
