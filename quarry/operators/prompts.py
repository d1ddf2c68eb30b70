"""Instruction, chat and benchmark formatting.

Row formats are single ``concat`` expressions. Conversation formats group
turns by ``conv_id`` (the output is one string per conversation, so the
conversation is the unit of work) and order them by ``turn`` inside the
aggregate. Few-shot prompts take the first ``k`` solved rows of each group
with a window whose group limit Spark applies before the shuffle
(``WindowGroupLimit``), so at most ``k`` rows per group and task move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import capitalize, words
from quarry.plans.joins import null_safe_join

# Special-token strings of the chat vocabulary.
EOS_TOKEN = "<|endoftext|>"
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
# Answer letters of a four-way multiple-choice item.
CHOICE_LETTERS = ["A", "B", "C", "D"]


def _s(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def instruction_text(instruction: Column, input_: Column, output: Column) -> Column:
    """Alpaca layout; the Input block only when ``input`` is non-empty."""
    with_input = F.concat(F.lit("### Instruction:\n"), _s(instruction),
                          F.lit("\n\n### Input:\n"), _s(input_),
                          F.lit("\n\n### Response:\n"), _s(output))
    without = F.concat(F.lit("### Instruction:\n"), _s(instruction),
                       F.lit("\n\n### Response:\n"), _s(output))
    return F.when(_s(input_) != "", with_input).otherwise(without)


def instruction_rows(conv: DataFrame) -> DataFrame:
    """Instruction rows from a turn table: a user turn is the instruction,
    the assistant turn right after it the output, the conversation's system
    text (if any) the input. Equi-joins on (conv_id, turn) and conv_id; a NULL
    conv_id is a conversation like any other, a turn without a number has no
    turn after it."""
    conv = conv.filter(F.col("turn").isNotNull() | (F.col("role") == "system"))
    users = conv.filter((F.col("role") == "user") & F.col("turn").isNotNull()).select(
        "conv_id", "turn", F.col("text").alias("instruction"))
    replies = conv.filter((F.col("role") == "assistant") & F.col("turn").isNotNull()).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    system = (conv.filter(F.col("role") == "system").groupBy("conv_id")
              .agg(F.min_by("text", F.coalesce("turn", F.lit((1 << 62)))).alias("input")))
    return null_safe_join(null_safe_join(users, replies, ["conv_id", "turn"]), system, ["conv_id"], "left")


def format_instruction(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn",
                       instruction_text(F.col("instruction"), F.col("input"),
                                        F.col("output")).alias("text"))


def line_roles(role: Column, text: Column) -> Column:
    name = F.when(role == "user", "Human").otherwise("Assistant")
    return F.concat(F.lit("### "), name, F.lit(": "), _s(text), F.lit("\n"))


def line_custom(role: Column, text: Column) -> Column:
    return F.concat(F.lit("### "), capitalize(_s(role)), F.lit(": "), _s(text), F.lit("\n"))


def line_chatml(role: Column, text: Column) -> Column:
    return F.concat(F.lit(IM_START), _s(role), F.lit("\n"), _s(text), F.lit(IM_END + "\n"))


def messages_text(messages: Column, line=line_chatml, suffix: str = IM_START + "assistant\n") -> Column:
    """Format of an ``array<struct<role, content>>``: row-local, no shuffle.
    A missing array has no turns; a missing role is empty."""
    lines = F.transform(F.coalesce(messages, F.array().cast("array<struct<role:string,content:string>>")),
                        lambda m: line(m["role"], m["content"]))
    return F.concat(F.array_join(lines, ""), F.lit(suffix))


def conversation_messages(conv: DataFrame) -> DataFrame:
    """``conv_id, messages``: the turns of each conversation as an array."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return conv.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def _per_conversation(conv: DataFrame, line: Column, suffix: str = "") -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct(F.col("turn"), line.alias("line"))))
    body = F.array_join(F.transform(ordered, lambda x: x["line"]), "")
    return conv.groupBy("conv_id").agg(F.concat(body, F.lit(suffix)).alias("text"))


def format_roles(conv: DataFrame) -> DataFrame:
    """``### Human: x`` for user turns, ``### Assistant: x`` for every other
    role (system included), one line per turn."""
    return _per_conversation(conv, line_roles(F.col("role"), F.col("text")))


def chat_custom(conv: DataFrame, add_generation_prompt: bool = True) -> DataFrame:
    """``### <Role>: content`` per turn, role capitalised (first letter up,
    rest down), then ``### Assistant: `` when a reply is requested."""
    return _per_conversation(conv, line_custom(F.col("role"), F.col("text")), "### Assistant: " if add_generation_prompt else "")


def chat_chatml(conv: DataFrame, add_generation_prompt: bool = True) -> DataFrame:
    """ChatML layout built from the start/end markers; a turn without a role
    keeps its text under an empty role."""
    return _per_conversation(conv, line_chatml(F.col("role"), F.col("text")), IM_START + "assistant\n" if add_generation_prompt else "")


def multiple_choice_rows(benchmark: DataFrame) -> DataFrame:
    """Multiple-choice items from the benchmark table: question = text,
    choices = its first four words, answer = item_id mod 4, subject =
    item_id mod 3."""
    return benchmark.select(
        "item_id", (F.col("item_id") % 3).alias("subject"), F.col("text").alias("question"),
        F.slice(words(_s(F.col("text"))), 1, 4).alias("choices"),
        (F.col("item_id") % 4).cast("int").alias("answer"))


def worked_answer_rows(benchmark: DataFrame) -> DataFrame:
    """Worked-answer items: question = text, answer = ``work\\n#### <item_id>``."""
    return benchmark.select("item_id", F.col("text").alias("question"),
                            F.concat(F.lit("work\n#### "), F.col("item_id").cast("string"))
                            .alias("answer"))


def mmlu_prompt(question: Column, choices: Column) -> Column:
    """``Question: q`` + ``X. choice`` lines + ``Answer:``; NULL for more
    than four choices (no letter for them)."""
    letters = F.array(*[F.lit(x) for x in CHOICE_LETTERS])
    lines = F.transform(choices, lambda c, i: F.concat(F.get(letters, i), F.lit(". "), c,
                                                       F.lit("\n")))
    prompt = F.concat(F.lit("Question: "), _s(question), F.lit("\n"),
                      F.array_join(lines, ""), F.lit("Answer:"))
    return F.when(F.size(choices) <= len(CHOICE_LETTERS), prompt)


def mmlu_label(answer: Column, choices: Column | None = None) -> Column:
    """The answer's letter; NULL for an item with more choices than letters
    (it has no prompt either)."""
    letters = F.array(*[F.lit(x) for x in CHOICE_LETTERS])
    label = F.get(letters, answer)
    return label if choices is None else F.when(F.size(choices) <= len(CHOICE_LETTERS), label)


def format_mmlu(mc: DataFrame) -> DataFrame:
    return mc.select("item_id", mmlu_prompt(F.col("question"), F.col("choices")).alias("prompt"),
                     mmlu_label(F.col("answer"), F.col("choices")).alias("label"))


def extract_answer(s: Column) -> Column:
    """Text after the first ``####`` (and any whitespace) up to the end of
    that line; NULL when there is no ``####``."""
    return F.when(s.contains("####"), F.regexp_extract(s, r"####\s*(.*)", 1))


def gsm8k_prompt(question: Column) -> Column:
    return F.concat(F.lit("Question: "), _s(question), F.lit("\nAnswer:"))


def format_gsm8k(wa: DataFrame) -> DataFrame:
    return wa.select("item_id", gsm8k_prompt(F.col("question")).alias("prompt"),
                     extract_answer(F.col("answer")).alias("answer"))


def few_shot(items: DataFrame, k: int, group_col: str | None = None,
             order_col: str = "item_id", max_groups: int | None = None) -> DataFrame:
    """``items(order_col, [group_col], prompt, label)`` → for every item after
    the first ``k`` of its group: the ``k`` solved examples
    (``prompt label\\n\\n`` each, in order) followed by its own prompt. An
    item without a key is no example and always gets a prompt, last in order.

    The shots table has at most ``k`` rows per group; it is broadcast only
    when the caller bounds the number of groups (``max_groups``)."""
    key = F.col(group_col) if group_col else F.lit(0)
    keyed = items.withColumn("_g", key)
    # Only the top k per group are ranked (row_number <= k becomes a partial
    # group limit before the exchange); the rest are found by key comparison.
    top = keyed.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_g").orderBy(F.asc_nulls_last(order_col)))
    ).filter((F.col("_rn") <= k) & F.col(order_col).isNotNull())
    shots = (top.groupBy("_g")
             .agg(F.array_join(F.transform(
                 F.array_sort(F.collect_list(F.struct(
                     F.col("_rn"), F.concat(F.col("prompt"), F.lit(" "), _s(F.col("label")),
                                            F.lit("\n\n")).alias("s")))),
                 lambda x: x["s"]), "").alias("_shots"),
                  F.max(order_col).alias("_last")))
    bound = None if (group_col and max_groups is None) else (max_groups or 1)
    joined = null_safe_join(keyed, shots if bound is None else F.broadcast(shots), ["_g"], "left")
    out = joined.filter(F.col(order_col).isNull() | (F.col(order_col) > F.col("_last")))
    return out.withColumn("prompt", F.concat(_s(F.col("_shots")), F.col("prompt"))).drop(
        "_g", "_shots", "_last")
