"""The registered queries: one callable ``(spark, base_dir) -> DataFrame``
per operator. Every query reads the dataset tables in full; limits appear
only where the limit is the operator (a first-N collection or a top-k)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import preview
from quarry.operators import (bpe_index, budget, calibration, classifier, dedup, keywords, language_profiles,
                              length_sketches, lsh_store, mixing, packing, prompts, quality, tokens, vectors)
from quarry.flagship import flagship
from quarry.plans.joins import join_small
from quarry.plans.parallel import spread
from quarry.session import scratch_path
from quarry.sources import jsonl_source
from quarry.sources.progressive import first_matching
from quarry.sources.tables import (DOCUMENT_SCHEMA, read_corpus, read_jsonl, sound_rows, table,
                                   take_first, write_jsonl, write_kept_removed)
from quarry.streaming import sinks as two_sinks
from quarry.streaming.filter_stream import stream_files, stream_filter, table_files

Query = Callable[[SparkSession, str], DataFrame]

# Keywords that occur in the synthetic corpus; the history list of the
# topic step finds nothing there and is covered by unit fixtures.
TEST_KEYWORDS = ["worthless", "license", "und"]


def _docs(spark: SparkSession, base: str) -> DataFrame:
    return spread(table(spark, base, "documents"))


def q_read_corpus(spark, base):
    return read_corpus(spark, f"{base}/documents.parquet", where=F.col("lang") == "en")


def q_take_first(spark, base):
    return take_first(_docs(spark, base), 100, "doc_id").select("doc_id", "n_chars")


def q_preview(spark, base):
    return _docs(spark, base).select("doc_id", preview(F.col("text"), 100).alias("snippet"))


def q_tag_source(spark, base):
    return _docs(spark, base).select("doc_id", F.lit("web").alias("source"))


def q_map_project(spark, base):
    conv = table(spark, base, "conversations")
    return conv.select(F.concat(F.lit("### "), F.col("role"), F.lit(": "),
                                F.coalesce(F.col("text"), F.lit(""))).alias("text"))


def q_gopher_filter(spark, base):
    return quality.gopher_filter(_docs(spark, base)).select("doc_id")


def q_gopher_reasons(spark, base):
    return quality.gopher_reasons(_docs(spark, base))


def q_split_kept_removed(spark, base):
    return quality.gopher_annotate(_docs(spark, base)).select("doc_id", "kept", "reason")


def q_language_filter(spark, base):
    out = quality.language_filter(_docs(spark, base), ["en", "de"], min_score=0.05)
    return out.select("doc_id", "lang", "predicted", F.round("score", 6).alias("score"))


def q_language_select(spark, base):
    return quality.language_select(table(spark, base, "documents"), ["en", "de"]).select("doc_id", "lang")


def q_topic_extract(spark, base):
    return quality.topic_extract(_docs(spark, base), TEST_KEYWORDS, 100).select("doc_id", "text")


def q_topic_hits(spark, base):
    return quality.topic_hits(_docs(spark, base), TEST_KEYWORDS)


def _keyed_copy(spark, base):
    """The documents as a table of several files in key order, as a collected corpus is stored."""
    path = scratch_path(spark, "keyed-documents")
    table(spark, base, "documents").repartitionByRange(16, "doc_id").write.parquet(path)
    return path


def q_take_first_progressive(spark, base):
    """The first 100 documents, reading only the files that hold them."""
    rows, _ = first_matching(spark, _keyed_copy(spark, base), F.lit(True), 100)
    return rows.select("doc_id", "n_chars")


def q_topic_extract_progressive(spark, base):
    """The first 100 documents on a topic, reading on only until they are found."""
    rows, _ = first_matching(spark, _keyed_copy(spark, base), quality.topic_match(F.col("text"), TEST_KEYWORDS), 100)
    return rows.select("doc_id", "text")


def _profiles(spark, base):
    return language_profiles.language_profiles(_docs(spark, base))


def q_language_profiles(spark, base):
    """The rank-order n-gram profile of every language, from all labelled documents."""
    return _profiles(spark, base)


def q_language_identify(spark, base):
    """Nearest profile of every document and its out-of-place distance."""
    known = language_profiles.collected(_profiles(spark, base))
    found = _docs(spark, base).select("doc_id", language_profiles.identify(F.col("text"), known).alias("f"))
    return found.select("doc_id", "f.predicted", "f.distance", "f.n_grams")


def q_language_profile_filter(spark, base):
    """Documents nearest to the English or German profile, not too far from it."""
    known = language_profiles.collected(_profiles(spark, base))
    kept = language_profiles.profile_filter(_docs(spark, base), known, ["en", "de"], 0.7)
    return kept.select("doc_id", "predicted", F.round("distance", 6).alias("distance"))


def _benchmark_words(spark, base):
    """The distinct words of the benchmark's texts, as a keyword list."""
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return keywords.keyword_list(table(spark, base, "benchmark").select(F.explode(words).alias("word")), "word")


def q_topic_hits_many(spark, base):
    """Documents that hold each word of the benchmark's texts."""
    return quality.topic_hits(_docs(spark, base), _benchmark_words(spark, base))


def q_topic_extract_many(spark, base):
    """All documents that hold a word of the benchmark's texts with ten letters or more."""
    long = [w for w in _benchmark_words(spark, base) if len(w) >= 10]
    return quality.topic_extract(_docs(spark, base), long).select("doc_id", "text")


def _conv(spark, base):
    return table(spark, base, "conversations")


def q_format_instruction(spark, base):
    return prompts.format_instruction(prompts.instruction_rows(_conv(spark, base)))


def q_format_roles(spark, base):
    return prompts.format_roles(_conv(spark, base))


def q_chat_custom(spark, base):
    return prompts.chat_custom(_conv(spark, base))


def q_chat_chatml(spark, base):
    return prompts.chat_chatml(_conv(spark, base))


def q_format_mmlu(spark, base):
    return prompts.format_mmlu(prompts.multiple_choice_rows(table(spark, base, "benchmark")))


def q_format_gsm8k(spark, base):
    return prompts.format_gsm8k(prompts.worked_answer_rows(table(spark, base, "benchmark")))


def q_extract_answer(spark, base):
    wa = prompts.worked_answer_rows(table(spark, base, "benchmark"))
    return wa.select("item_id", prompts.extract_answer(F.col("answer")).alias("answer"))


def q_few_shot(spark, base):
    mc = prompts.multiple_choice_rows(table(spark, base, "benchmark"))
    items = mc.select("item_id", "subject",
                      prompts.mmlu_prompt(F.col("question"), F.col("choices")).alias("prompt"),
                      prompts.mmlu_label(F.col("answer"), F.col("choices")).alias("label"))
    return prompts.few_shot(items, 5, group_col="subject").select(
        "item_id", "subject", "prompt", "label")


def q_few_shot_gsm8k(spark, base):
    items = prompts.format_gsm8k(prompts.worked_answer_rows(table(spark, base, "benchmark")))
    items = items.withColumnRenamed("answer", "label")
    return prompts.few_shot(items, 3).select("item_id", "prompt", "label")


def _signatures(spark, base):
    return dedup.minhash_signatures(_docs(spark, base))


def q_exact_dedup(spark, base):
    return dedup.exact_dedup(_docs(spark, base)).select("doc_id")


def q_shingles(spark, base):
    return dedup.with_shingles(_docs(spark, base)).select(
        "doc_id", F.size("shingles").cast("long").alias("n_shingles"))


def q_minhash_signature(spark, base):
    return _signatures(spark, base).select(
        "doc_id", F.array_join("signature", " ").alias("signature"))


def q_lsh_buckets(spark, base):
    return dedup.lsh_buckets(dedup.band_keys(_signatures(spark, base)))


def q_candidate_edges(spark, base):
    return dedup.candidate_edges(dedup.band_keys(_signatures(spark, base)))


def q_dup_clusters(spark, base):
    return dedup.duplicate_clusters(_docs(spark, base))


def q_dup_clusters_incremental(spark, base):
    """Clusters of the documents arriving in three increments, by a hash of their source."""
    docs = _docs(spark, base)
    store = lsh_store.LshStore(spark, scratch_path(spark, "lsh-store"))
    arrival = F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 3
    for k in range(3):
        store.add(docs.filter(arrival == k), f"arrival{k}")
    return store.clusters()


def q_minhash_dedup(spark, base):
    return dedup.minhash_dedup(_docs(spark, base)).select("doc_id")


def q_dup_removed(spark, base):
    return dedup.duplicates_removed(_docs(spark, base)).select("doc_id", "cluster_id")


# Token-id conventions: bytes 0-255, learned merges from 256, special ids
# right after the last merge.
BPE_MERGES = 10
BYTE_EOS = 256


def _specials(n_merges: int) -> dict[str, int]:
    base = 256 + n_merges
    return {prompts.EOS_TOKEN: base, prompts.IM_START: base + 1, prompts.IM_END: base + 2}


def _ids_str(c):
    return F.array_join(c, " ")


def _byte_ids(spark, base):
    return _docs(spark, base).select("doc_id", tokens.byte_tokens(F.col("text")).alias("ids"))


def q_byte_tokens(spark, base):
    return _byte_ids(spark, base).select("doc_id", _ids_str(F.col("ids")).alias("tokens"))


def q_pair_counts(spark, base):
    return tokens.pair_counts(tokens.byte_chunks(_docs(spark, base))).select("left_id", "right_id", "n")


def _trained(spark, base, n):
    docs = _docs(spark, base)
    return docs, tokens.bpe_train(docs, n)


def q_bpe_train_words(spark, base):
    merges = tokens.bpe_train(_docs(spark, base), BPE_MERGES, chunking="word")
    return tokens.merges_frame(spark, merges)


INDEXED_MERGES = 20


def q_bpe_train_indexed(spark, base):
    """Merges learned on words, each reading only the chunks that hold its pair."""
    merges, _ = bpe_index.bpe_train_indexed(table(spark, base, "documents"), INDEXED_MERGES)
    return tokens.merges_frame(spark, merges)


def q_bpe_merge(spark, base):
    docs, merges = _trained(spark, base, 1)
    return docs.select("doc_id", _ids_str(tokens.bpe_encode(F.col("text"), merges)).alias("tokens"))


def q_bpe_train(spark, base):
    _, merges = _trained(spark, base, BPE_MERGES)
    return tokens.merges_frame(spark, merges)


def q_bpe_encode(spark, base):
    docs, merges = _trained(spark, base, BPE_MERGES)
    enc = docs.select("doc_id", tokens.bpe_encode(F.col("text"), merges).alias("ids"))
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      _ids_str(F.col("ids")).alias("tokens"))


def q_bpe_decode(spark, base):
    docs, merges = _trained(spark, base, BPE_MERGES)
    enc = docs.select("doc_id", tokens.bpe_encode(F.col("text"), merges).alias("ids"))
    return enc.select("doc_id", tokens.bpe_decode(F.col("ids"), merges).alias("text"))


def q_token_pieces(spark, base):
    docs, merges = _trained(spark, base, BPE_MERGES)
    enc = docs.select("doc_id", F.posexplode(tokens.bpe_encode(F.col("text"), merges))
                      .alias("pos", "token_id"))
    vocab = tokens.vocabulary(spark, merges).select("token_id", "piece_hex")
    return join_small(enc, vocab, "token_id", max_rows=256 + len(merges)).select(
        "doc_id", "pos", "token_id", "piece_hex")


def q_chatml_messages(spark, base):
    messages = prompts.conversation_messages(_conv(spark, base))
    return messages.select("conv_id", prompts.messages_text(F.col("messages")).alias("text"))


def q_chat_roundtrip(spark, base):
    """Chat text encoded with its special markers and decoded again."""
    _, merges = _trained(spark, base, BPE_MERGES)
    specials = _specials(len(merges))
    ids = prompts.chat_chatml(_conv(spark, base)).select("conv_id", tokens.bpe_encode(F.col("text"), merges, specials).alias("ids"))
    return ids.select("conv_id", tokens.bpe_decode(F.col("ids"), merges, specials).alias("text"))


def q_chat_tokenized(spark, base):
    docs, merges = _trained(spark, base, BPE_MERGES)
    chat = prompts.chat_chatml(_conv(spark, base))
    ids = tokens.bpe_encode(F.col("text"), merges, _specials(len(merges)))
    enc = chat.select("conv_id", ids.alias("ids"))
    return enc.select("conv_id", F.size("ids").cast("long").alias("n_tokens"),
                      _ids_str(F.col("ids")).alias("tokens"))


def q_token_stats(spark, base):
    d = _docs(spark, base).select("lang", F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
                                  .alias("n_tokens"))
    return tokens.token_stats(d, by=["lang"])


def q_token_histogram(spark, base):
    d = _docs(spark, base).select(F.octet_length(F.coalesce("text", F.lit(""))).alias("n_tokens"))
    return tokens.token_histogram(d, [2048, 4096, 32768, 131072])


PERCENTILES = [0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def q_token_percentiles(spark, base):
    """Percentiles of the documents' lengths in bytes, from sketches of two
    stored runs (one for each half of the sources' names by their hash), with
    the exact ranks of the answers: whether each lies within the error bound."""
    lengths = _docs(spark, base).select("lang", (F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 2).alias("half"),
                                        F.octet_length(F.coalesce("text", F.lit(""))).alias("n_tokens"))
    path = scratch_path(spark, "length-runs")
    for half in (0, 1):
        length_sketches.store_run(length_sketches.sketch_lengths(lengths.filter(F.col("half") == half), by=["lang"]), path, f"half{half}")
    merged = length_sketches.merge_runs(length_sketches.stored_runs(spark, path), ["lang"])
    answers = length_sketches.percentiles(merged, PERCENTILES)
    error = length_sketches.rank_error()
    ranked = length_sketches.rank_bounds(lengths, answers, by=["lang"])
    within = (F.col("below") - error <= F.col("p")) & (F.col("p") <= F.col("upto") + error)
    return ranked.select("lang", "p", "n", within.alias("within_bound"))


def _padded(spark, base):
    ids, mask = tokens.truncate_pad(F.col("ids"), 256, BYTE_EOS)
    first = _docs(spark, base).select("doc_id", tokens.first_byte_tokens(F.col("text"), 256).alias("ids"))
    return first.select("doc_id", ids.alias("input_ids"), mask.alias("mask"))


def q_truncate(spark, base):
    first = tokens.first_byte_tokens(F.col("text"), 512)
    return _docs(spark, base).select("doc_id", _ids_str(first).alias("input_ids"))


def q_truncate_pad(spark, base):
    return _padded(spark, base).select("doc_id", _ids_str(F.col("input_ids")).alias("input_ids"),
                                       _ids_str(F.col("mask")).alias("attention_mask"))


def q_lm_labels(spark, base):
    return _padded(spark, base).select(
        "doc_id", _ids_str(tokens.lm_labels(F.col("input_ids"), BYTE_EOS)).alias("labels"))


def q_append_eos(spark, base):
    ids = tokens.append_eos(F.col("ids"), BYTE_EOS)
    return _byte_ids(spark, base).select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                                         F.element_at(ids, -1).alias("last_id"))


def q_pack_tokens(spark, base):
    docs = _docs(spark, base).select("doc_id", "text")
    n_bytes = F.octet_length(F.coalesce("text", F.lit("")))
    return packing.pack_tokens(docs, 1024, BYTE_EOS, ids=tokens.byte_tokens(F.col("text")), lengths=n_bytes).select(
        "block_id", _ids_str(F.col("tokens")).alias("tokens"))


def q_pack_report(spark, base):
    d = _docs(spark, base).select(F.octet_length(F.coalesce("text", F.lit(""))).alias("n_tokens"))
    return packing.pack_report(d, 1024, BYTE_EOS)


def _grouped_docs(spark, base):
    d = _docs(spark, base)
    return d.select("doc_id", "text", mixing.source_group(F.col("source")).alias("source"))


def _mixed(spark, base):
    return mixing.mix_sources(_grouped_docs(spark, base).select("doc_id", "source"))


def q_mix_sources(spark, base):
    return _mixed(spark, base).select("pos", "source", "doc_id")


def q_seeded_shuffle(spark, base):
    return mixing.seeded_shuffle(_docs(spark, base).select("doc_id")).select("pos", "doc_id")


def q_mix_report(spark, base):
    return mixing.mix_report(_mixed(spark, base), 1000)


def _emb(spark, base):
    return table(spark, base, "embeddings")


def q_quantize_absmax(spark, base):
    out = vectors.absmax_quantize(_emb(spark, base), "label")
    return out.select("vec_id", "scale", _ids_str(F.col("q")).alias("q"))


def q_quantize_zeropoint(spark, base):
    out = vectors.zeropoint_quantize(_emb(spark, base), "label")
    return out.select("vec_id", "scale", "zero_point", _ids_str(F.col("q")).alias("q"))


def _restored(spark, base):
    both = vectors.quantize_both(_emb(spark, base), "label")
    return both.select("vec_id", "label", "embedding", F.inline("quantized"))


def q_dequantize(spark, base):
    return _restored(spark, base).select("vec_id", "method", F.posexplode("values").alias("idx", "value"))


def q_quantize_error(spark, base):
    per = _restored(spark, base).select("label", "method", vectors.squared_error_sum(F.col("embedding"), F.col("values")).alias("se"),
                                        vectors.error_count(F.col("embedding"), F.col("values")).alias("n"))
    return per.groupBy("label", "method").agg(
        F.round(F.sum("se") / F.sum("n"), 12).alias("mse"))


def q_embedding_lookup(spark, base):
    ids = _byte_ids(spark, base)
    table_ = _emb(spark, base).select(
        "vec_id", F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0),
                                              lambda acc, x: acc + x.cast("double") * x.cast("double"))), 6)
        .alias("norm"))
    return vectors.embedding_lookup(ids, table_, vocab_rows=256).select("doc_id", "pos", "vec_id", "norm")


def q_embedding_lookup_skewed(spark, base):
    """The lookup with no bound on the vocabulary: hot ids found by a sketch."""
    path = scratch_path(spark, "byte-ids")
    _byte_ids(spark, base).write.parquet(path)
    norms = _emb(spark, base).select("vec_id", F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))), 6).alias("norm"))
    return vectors.embedding_lookup_skewed(spark.read.parquet(path), norms).select("doc_id", "pos", "vec_id", "norm")


def q_buffered_shuffle(spark, base):
    """The documents in the order in which a buffer of 1,000 rows lets them out."""
    return mixing.buffered_shuffle(_docs(spark, base).select("doc_id")).select("pos", "doc_id")


def q_token_budget(spark, base):
    d = _grouped_docs(spark, base).select(
        "source", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("n_tokens"))
    return budget.token_budget(d, dict(zip(mixing.MIX_SOURCES, mixing.MIX_PROBABILITIES)), 1e21)


def q_jsonl_roundtrip(spark, base):
    path = scratch_path(spark, "jsonl")
    write_jsonl(_docs(spark, base), path)
    return sound_rows(read_jsonl(spark, path))


def q_jsonl_source(spark, base):
    """The documents written and read again by the JSON Lines data source."""
    jsonl_source.register(spark)
    path = scratch_path(spark, "jsonl-source")
    docs = _docs(spark, base)
    docs.write.format(jsonl_source.NAME).option("maxFileBytes", 1 << 20).mode("append").save(path)
    return spark.read.format(jsonl_source.NAME).schema(docs.schema).option("splitBytes", 1 << 19).load(path)


def q_kept_removed_sinks(spark, base):
    """Both sides written in one pass, read back with the folder's flag."""
    path = scratch_path(spark, "kept-removed")
    write_kept_removed(quality.gopher_annotate(_docs(spark, base)).select("doc_id", "text", "kept", "reason"), path)
    schema = "doc_id long, text string, reason string, kept boolean"
    return spark.read.schema(schema).json(path).select("doc_id", "kept", "reason")


def q_stream_filter(spark, base):
    def annotate(df):
        return quality.gopher_annotate(df).select("doc_id", "kept", "reason")
    return stream_filter(spark, table_files(base, "documents"), DOCUMENT_SCHEMA, annotate)


def q_stream_sinks(spark, base):
    """Kept and removed records of the document stream, from the two sinks behind it."""
    path = scratch_path(spark, "stream-sinks")
    stream = stream_files(spark, table_files(base, "documents"), DOCUMENT_SCHEMA)
    two_sinks.run_two_sinks(stream, lambda df: quality.gopher_annotate(df).select("doc_id", "text", "reason", "kept"), path, scratch_path(spark, "stream-sinks-ckpt"))
    return two_sinks.read_sinks(spark, path, T.StructType().add("doc_id", "long").add("text", "string").add("reason", "string")).select("doc_id", "kept", "reason")


def q_stream_topic(spark, base):
    """The topic filter over the document stream."""
    return stream_filter(spark, table_files(base, "documents"), DOCUMENT_SCHEMA, lambda df: quality.topic_extract(df, TEST_KEYWORDS).select("doc_id", "text"))


def q_stream_prompts(spark, base):
    """Prompts made of the benchmark as it arrives."""
    schema = T.StructType().add("item_id", "long").add("text", "string")
    return stream_filter(spark, table_files(base, "benchmark"), schema, lambda df: prompts.format_gsm8k(prompts.worked_answer_rows(df)))


def q_quality_classifier(spark, base):
    return classifier.quality_classifier(_docs(spark, base), table(spark, base, "labels"))


def q_quality_holdout(spark, base):
    return classifier.quality_holdout(_docs(spark, base), table(spark, base, "labels"))


def _letter_scores(spark, base):
    """The labelled documents with the share of ``a`` to ``z`` in their texts as a score."""
    text = F.coalesce("text", F.lit(""))
    share = F.length(F.regexp_replace(text, "[^a-z]", "")).cast("double") / F.greatest(F.length(text), F.lit(1))
    labels = table(spark, base, "labels").select("doc_id", F.col("quality").alias("label"))
    return _docs(spark, base).select("doc_id", share.alias("score")).join(labels, "doc_id")


def q_score_auc(spark, base):
    """How well the share of plain letters separates good documents from bad ones."""
    return calibration.auc(_letter_scores(spark, base)).select("n_pos", "n_neg", F.round("auc", 9).alias("auc"))


def q_score_confusion(spark, base):
    """Confusion cells of the share of plain letters at several thresholds."""
    return calibration.confusion(_letter_scores(spark, base), [0.5, 0.6, 0.7, 0.75, 0.8, 0.85])


# Every whole text changed so that one rule fires: what is added grows with the
# text (``t``, never NULL), as a rule compares shares of it.
RULE_CASES = {
    "avg_word_low": "concat(t, ' ', repeat('a b ', length(t) + 40))",
    "avg_word_high": "concat(t, ' ', repeat(concat(repeat('abcdefghij', 6), ' '), cast(60 + floor(length(t) / 8) as int)))",
    "ellipsis_ratio": "concat(t, ' ', repeat('word... and the ', cast(30 + floor(length(t) / 8) as int)))",
    "bullet_lines": "concat(repeat('- the words of a longlist\n', 20), '- ', replace(t, '\n', '\n- '))",
    "ellipsis_lines": "concat(repeat('the long words of one line and of the next lines that go on ...\n', 10), replace(t, '\n', ' ...\n'), ' ...')",
    "stop_words": "concat(repeat('the word ', 40), regexp_replace(t, '[tbohwd]', 'x'))",
}
# The texts as they are, under a bound of so many words: 100,000 words are
# more than any of them has.
LONG_RULE = quality.GopherRules(max_doc_words=200)


def q_gopher_rule_cases(spark, base):
    """The first failing rule of every whole text changed to break one rule,
    and of the texts as they are under a lower bound for long ones."""
    docs = _docs(spark, base).select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    made = docs.select("doc_id", F.expr("inline(array(" + ", ".join(f"struct('{name}' AS rule, {text} AS text)" for name, text in RULE_CASES.items()) + "))"))
    long = docs.select("doc_id", F.lit("long_doc").alias("rule"), F.col("t").alias("text"))
    return quality.gopher_annotate(made).unionByName(quality.gopher_annotate(long, rules=LONG_RULE)).select("doc_id", "rule", "reason")


def q_flagship(spark, base):
    return flagship(spark, base)


QUERIES: dict[str, Query] = {
    "read_corpus": q_read_corpus,
    "take_first": q_take_first,
    "preview": q_preview,
    "tag_source": q_tag_source,
    "map_project": q_map_project,
    "gopher_filter": q_gopher_filter,
    "gopher_reasons": q_gopher_reasons,
    "split_kept_removed": q_split_kept_removed,
    "language_filter": q_language_filter,
    "language_select": q_language_select,
    "topic_extract": q_topic_extract,
    "topic_hits": q_topic_hits,
    "topic_hits_many": q_topic_hits_many,
    "take_first_progressive": q_take_first_progressive,
    "topic_extract_progressive": q_topic_extract_progressive,
    "language_profiles": q_language_profiles,
    "language_identify": q_language_identify,
    "language_profile_filter": q_language_profile_filter,
    "topic_extract_many": q_topic_extract_many,
    "format_instruction": q_format_instruction,
    "format_roles": q_format_roles,
    "chat_custom": q_chat_custom,
    "chat_chatml": q_chat_chatml,
    "format_mmlu": q_format_mmlu,
    "format_gsm8k": q_format_gsm8k,
    "extract_answer": q_extract_answer,
    "few_shot": q_few_shot,
    "few_shot_gsm8k": q_few_shot_gsm8k,
    "exact_dedup": q_exact_dedup,
    "shingles": q_shingles,
    "minhash_signature": q_minhash_signature,
    "lsh_buckets": q_lsh_buckets,
    "candidate_edges": q_candidate_edges,
    "dup_clusters": q_dup_clusters,
    "dup_clusters_incremental": q_dup_clusters_incremental,
    "minhash_dedup": q_minhash_dedup,
    "dup_removed": q_dup_removed,
    "byte_tokens": q_byte_tokens,
    "pair_counts": q_pair_counts,
    "bpe_merge": q_bpe_merge,
    "bpe_train": q_bpe_train,
    "bpe_train_words": q_bpe_train_words,
    "bpe_train_indexed": q_bpe_train_indexed,
    "bpe_encode": q_bpe_encode,
    "bpe_decode": q_bpe_decode,
    "token_pieces": q_token_pieces,
    "chat_tokenized": q_chat_tokenized,
    "token_stats": q_token_stats,
    "token_histogram": q_token_histogram,
    "token_percentiles": q_token_percentiles,
    "truncate_pad": q_truncate_pad,
    "lm_labels": q_lm_labels,
    "append_eos": q_append_eos,
    "pack_tokens": q_pack_tokens,
    "pack_report": q_pack_report,
    "mix_sources": q_mix_sources,
    "seeded_shuffle": q_seeded_shuffle,
    "buffered_shuffle": q_buffered_shuffle,
    "mix_report": q_mix_report,
    "quantize_absmax": q_quantize_absmax,
    "quantize_zeropoint": q_quantize_zeropoint,
    "dequantize": q_dequantize,
    "quantize_error": q_quantize_error,
    "embedding_lookup": q_embedding_lookup,
    "embedding_lookup_skewed": q_embedding_lookup_skewed,
    "token_budget": q_token_budget,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "jsonl_source": q_jsonl_source,
    "stream_filter": q_stream_filter,
    "stream_sinks": q_stream_sinks,
    "stream_topic": q_stream_topic,
    "stream_prompts": q_stream_prompts,
    "quality_classifier": q_quality_classifier,
    "quality_holdout": q_quality_holdout,
    "score_auc": q_score_auc,
    "score_confusion": q_score_confusion,
    "gopher_rule_cases": q_gopher_rule_cases,
    "kept_removed_sinks": q_kept_removed_sinks,
    "chatml_messages": q_chatml_messages,
    "chat_roundtrip": q_chat_roundtrip,
    "truncate": q_truncate,
    "flagship": q_flagship,
}
