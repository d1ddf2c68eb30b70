"""Quality and topic filters on hand-made edge rows."""

from pyspark.sql import functions as F

from quarry.operators import quality
from tests.conftest import docs_df

GOOD = " ".join(["the cat and the dog walked with care to the old mill"] * 5)


def reasons(spark, texts):
    df = docs_df(spark, texts)
    return [r.reason for r in quality.gopher_annotate(df).orderBy("doc_id").collect()]


def test_gopher_rules(spark):
    texts = [
        GOOD,                                   # kept
        None,                                   # short
        "",                                     # short
        " ".join(["word"] * 49),                # 49 words: short
        " ".join(["ab"] * 60),                  # avg length 2 < 3
        " ".join(["abcdefghijkl"] * 60),        # avg length 12 > 10
        GOOD + " " + "#" * 20,                  # hash ratio
        GOOD + " ... ... ... ... ... ... ... ...",  # ellipsis ratio
        "\n".join(["- item number one of the list and the"] * 12),  # bullet lines
        "\n".join(["the line trails off and the rest of the words go on and on ..."] * 12),
        " ".join(["12345"] * 60 + ["the", "and"]),                 # few alpha words
        " ".join(["bonjour le monde est grand"] * 12),             # stop words
    ]
    assert reasons(spark, texts) == [None, "short_doc", "short_doc", "short_doc", "avg_word_low",
                                     "avg_word_high", "hash_ratio", "ellipsis_ratio",
                                     "bullet_lines", "ellipsis_lines", "alpha_words", "stop_words"]


def test_fifty_words_pass_length_rule(spark):
    text = " ".join(["the cat and dog"] * 12 + ["bird", "fish"])  # 50 words
    assert reasons(spark, [text]) == [None]


def test_topic_whole_words(spark):
    texts = ["A history of Rome", "ANCIENT coins.", "the war,", "warm weather", "prehistory notes",
             "empireé", "civilization!", "dynasty_x", "archaeology"]
    df = docs_df(spark, texts)
    got = [r.doc_id for r in quality.topic_extract(df, quality.HISTORY_KEYWORDS).collect()]
    assert got == [0, 1, 2, 6, 8]


def test_topic_extract_limit_is_first_n_by_id(spark):
    df = docs_df(spark, ["war"] * 30)
    got = [r.doc_id for r in quality.topic_extract(df, ["war"], limit=10).collect()]
    assert got == list(range(10))


def test_topic_hits_counts_each_keyword(spark):
    df = docs_df(spark, ["war and empire", "war", "nothing"])
    got = {r.keyword: r.n_docs for r in quality.topic_hits(df, ["war", "empire", "dynasty"]).collect()}
    assert got == {"war": 2, "empire": 1, "dynasty": 0}


def test_language_scores(spark):
    df = docs_df(spark, ["the cat and the dog", "der Hund und die Katze", "le chat et les chiens"])
    got = [r.predicted for r in quality.language_annotate(df).orderBy("doc_id").collect()]
    assert got == ["en", "de", "fr"]


def test_fenced_filter_computes_words_once(spark):
    df = docs_df(spark, [GOOD, "short"])
    plan = quality.gopher_filter(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2  # the word split and the line split, once each
    assert "Generate" in plan


def test_language_select_pushes_down(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = quality.language_select(df, ["en"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(lang" in plan or "PushedFilters: [IsNotNull(lang), EqualTo(lang" in plan


def test_stop_words_are_counted_once(spark):
    assert reasons(spark, [" ".join(["the word"] * 30), " ".join(["the word of"] * 30)]) == ["stop_words", None]


def test_long_doc(spark):
    assert reasons(spark, [" ".join(["the", "words", "of"] * 33_334), " ".join(["the", "words", "of"] * 33_333)]) == ["long_doc", None]


def test_topic_extract_without_limit_takes_all(spark):
    df = docs_df(spark, ["war"] * 30)
    assert quality.topic_extract(df, ["war"]).count() == 30


def test_words_are_counted_in_the_text_itself(spark):
    plan = quality.gopher_annotate(docs_df(spark, [GOOD]))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda w_" not in plan and "RLIKE" not in plan  # no expression is interpreted for each word


def test_odd_words_count_as_words_do(spark):
    near = "the of " + "abcd " * 38
    texts = [near + "été " * 10, near + "— " * 10, near + "--\U0001d5ba- " * 10, near + "٣ " * 10,  # letters, none, beyond the BMP, digits
             near + "a b\u0085c " * 10, "\n\x0b " + near + "\t\f\r" + "x1 " * 10 + "\t",  # only ASCII white space divides
             "the of " + "word " * 50 + "-" * 300_000, "the of " + "--word " * 40 + "12 ** " * 16]  # one long word of symbols
    assert reasons(spark, texts) == [None, "short_doc", None, None, None, None, None, "alpha_words"]
