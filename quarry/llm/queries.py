"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import chat_collapse, collocations, cover_codes, curriculum, kmeans_tree, language_id, line_chunks, ngram_join, pii, quality_rules, secret_scan, sentencepiece_bpe, suffix_dedup
from quarry.llm.common import checkpointed


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, base: str) -> DataFrame:
    """Ids and round trip of every whole text with the public 32k vocabulary."""
    import public_tokenizers

    return sentencepiece_bpe.encode_decode(_table(spark, base, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_ngram_join(spark: SparkSession, base: str) -> DataFrame:
    """Components of texts whose 4-word shingle sets are at least 85 % similar."""
    return ngram_join.components(_table(spark, base, "documents"), k=4, percent=85)


def op3_kmeans_tree(spark: SparkSession, base: str) -> DataFrame:
    """The 20 nearest found of every 20th vector by inner product."""
    return kmeans_tree.search(_table(spark, base, "embeddings"), "vec_id % 20 = 0", 20)


def op4_curriculum(spark: SparkSession, base: str) -> DataFrame:
    """The words that the mix takes of every document, and its places in training order."""
    mixed = curriculum.per_document(curriculum.plan(_table(spark, base, "documents")))
    return mixed.withColumn("first_position", F.round("first_position", 6))


def op5_language_id(spark: SparkSession, base: str) -> DataFrame:
    """Language of every whole text, learned from the documents that are not held out."""
    docs = _table(spark, base, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.train(docs, ~held_out)
    return language_id.classify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_chat_collapse(spark: SparkSession, base: str) -> DataFrame:
    """Rendered turns of the conversations that are no prefix of another."""
    return chat_collapse.collapse(_table(spark, base, "conversations"))


def op7_suffix_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Bytes of every whole text covered by 100-byte strings that also start earlier."""
    done = suffix_dedup.dedup(_table(spark, base, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_secret_scan(spark: SparkSession, base: str) -> DataFrame:
    """Secrets of every whole text, each distinct text scanned once: the rows come as two versions, and the second scans what the first left unseen."""
    docs = _table(spark, base, "documents")
    late = F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 1
    found, _ = secret_scan.scan_versions([docs.filter(~late), docs.filter(late)])
    of_base = F.filter("found", lambda s: s["kind"].isin(*[r.kind for r in secret_scan.RULES if r.base]))
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(secret_scan.listed(of_base), 256).alias("base_sha256"), secret_scan.listed(F.col("found")).alias("spans"))


def op9_quality_rules(spark: SparkSession, base: str) -> DataFrame:
    """Counts of every whole text and the verdict of the learned decision list."""
    counted = checkpointed(quality_rules.text_counts(_table(spark, base, "documents")))
    rules = quality_rules.learn(counted, _table(spark, base, "labels"))
    return quality_rules.verdicts(counted, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op10_line_chunks(spark: SparkSession, base: str) -> DataFrame:
    """Lines of every whole text, those removed as repeated chunks, and what is left."""
    done = line_chunks.dedup(_table(spark, base, "documents"))
    return done.select("doc_id", "_lines.n_lines", "_lines.n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op12_cover_codes(spark: SparkSession, base: str) -> DataFrame:
    """Product codes of all vectors after two Lloyd rounds."""
    done, books = cover_codes.compress(_table(spark, base, "embeddings"))
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return done.select("vec_id", code.alias("code"), "error", "label_error", F.lit(cover_codes.digest(books)).alias("codebooks_sha256"))


def op13_pii(spark: SparkSession, base: str) -> DataFrame:
    """Personal data of every whole text, and the terms near it that reveal it."""
    found = pii.scan(_table(spark, base, "documents"))
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    of_base = F.filter("found", lambda s: s["kind"] < len(pii.BASE_KINDS))
    return found.select("doc_id", *map(number, pii.BASE_KINDS), F.sha2(pii.listed(of_base), 256).alias("base_sha256"), pii.listed(F.col("found")).alias("spans"), number("general"), number("removed"))


def op11_collocations(spark: SparkSession, base: str) -> DataFrame:
    """The 2,000 highest-scoring phrases of two to five words of each language."""
    return collocations.mine(_table(spark, base, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


QUERIES = {
    "op11_collocations": op11_collocations,
    "op13_pii": op13_pii,
    "op12_cover_codes": op12_cover_codes,
    "op3_kmeans_tree": op3_kmeans_tree,
    "op6_chat_collapse": op6_chat_collapse,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op10_line_chunks": op10_line_chunks,
    "op2_ngram_join": op2_ngram_join,
    "op5_language_id": op5_language_id,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_rules": op9_quality_rules,
    "op4_curriculum": op4_curriculum,
    "op1_sentencepiece": op1_sentencepiece,
}

ORACLES: dict[str, str] = {}

ORACLES["op6_chat_collapse"] = r"""
WITH placed AS (
  SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text, coalesce('r' || role, 'n') || chr(10) || coalesce(text, '') AS own,
         row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(coalesce('r' || role, 'n') || chr(10) || coalesce(text, '')))),
rolled AS (
  SELECT *, md5(string_agg(md5(own), ',') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)) AS prefix FROM placed),
kept AS (
  SELECT min(conv_id) AS conv_id FROM rolled l WHERE place = n_turns
     AND NOT EXISTS (SELECT 1 FROM rolled r WHERE r.place < r.n_turns AND r.place = l.n_turns AND r.prefix = l.prefix)
  GROUP BY n_turns, prefix)
SELECT conv_id, place, n_turns, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered
FROM placed JOIN kept USING (conv_id)
"""

ORACLES["op10_line_chunks"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
ended AS (
  SELECT *, (((coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) * 31 + h) >> 8) % 4 = 0)::INT AS ends FROM hashed),
placed AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM ended),
chunked AS (
  SELECT doc_id, place, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n, count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS worded FROM placed GROUP BY ALL),
judged AS (
  SELECT *, n >= 2 AND worded >= 2 AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, place) > 1 AS removed FROM chunked)
SELECT doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (removed), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(chunk, chr(10) ORDER BY place) FILTER (NOT removed), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

#: Places of all matches: what lies between them and the matches themselves, summed up.
_SPANS = r"""
  SELECT doc_id, '{kind}' AS kind, {place} AS place, unnest(starts) AS "start", unnest(ends) AS "end", unnest(judged) AS judged FROM (
    SELECT doc_id, judged, list_transform(generate_series(1, len(hits)), lambda i: (list_sum(gaps[1:i]) + coalesce(list_sum(hits[1:i - 1]), 0))::BIGINT) AS starts,
           list_transform(generate_series(1, len(hits)), lambda i: (list_sum(gaps[1:i]) + list_sum(hits[1:i]))::BIGINT) AS ends
    FROM (SELECT doc_id, list_transform(string_split_regex(text, $${pattern}$$), lambda x: length(x)) AS gaps,
                 list_transform(regexp_extract_all(text, $${pattern}$$, 0), lambda x: length(x)) AS hits,
                 list_transform(regexp_extract_all(text, $${pattern}$$, {group}), lambda x: length(x)) AS judged
          FROM documents WHERE regexp_matches(text, $${pattern}$$)))
"""

ORACLES["op8_secret_scan"] = "WITH every AS (" + " UNION ALL ".join(
    f"SELECT * FROM ({_SPANS.format(kind=r.kind, place=i, pattern=r.pattern, group=r.group)}) WHERE judged >= {r.least}" for i, r in enumerate(secret_scan.RULES)) + r"""),
rows AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || "start" || ':' || "end", ',' ORDER BY "start", place) FILTER (place < 3) AS base,
         string_agg(kind || ':' || "start" || ':' || "end", ',' ORDER BY "start", place) AS spans
  FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN rows USING (doc_id)
"""

ORACLES["op4_curriculum"] = r"""
WITH sized AS (
  SELECT doc_id, coalesce('a' || source, 'b') AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS key
  FROM documents),
weighed AS (
  SELECT src, source_size, 2 * source_size AS most,
         CASE rn % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight,
         CASE rn % 3 WHEN 1 THEN 0.5::DOUBLE WHEN 2 THEN 0.0::DOUBLE ELSE (-0.5)::DOUBLE END AS slope
  FROM (SELECT src, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY src) AS rn FROM sized GROUP BY src)),
stops AS (
  SELECT *, coalesce(sum(most) OVER w, 0) AS most_before, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM weighed WINDOW w AS (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (
  SELECT max(((SELECT sum(size) FROM sized)::DOUBLE * 1.5 - most_before::DOUBLE) / ((SELECT sum(weight) FROM weighed) - weight_before)::DOUBLE) AS level FROM stops),
goal AS (SELECT src, source_size, slope, least(most::DOUBLE, level * weight) AS target FROM stops, lvl),
placed AS (
  SELECT sized.*, source_size, slope, target, floor(target + 0.5)::BIGINT AS quota,
         coalesce(sum(size) OVER (PARTITION BY src ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN goal USING (src)),
taking AS (
  SELECT *, greatest(least(quota - start, size), 0) AS w0, greatest(least(quota - start - source_size, size), 0) AS w1 FROM placed),
timed AS (
  SELECT src, start, copy, doc_id, words, slope, slope + 1.0::DOUBLE AS b, ("begin" + words / 2.0::DOUBLE) / target AS y
  FROM (SELECT src, start, start AS "begin", 0 AS copy, doc_id, w0 AS words, slope, target FROM taking UNION ALL
        SELECT src, start, start + source_size, 1, doc_id, w1, slope, target FROM taking) WHERE words > 0),
mixed AS (
  SELECT *, row_number() OVER (ORDER BY position, doc_id NULLS FIRST, copy, src, start) AS place FROM (
    SELECT *, CASE WHEN slope = 0 THEN y ELSE (b - sqrt(greatest(b * b - slope * 4.0::DOUBLE * y, 0.0))) / (slope * 2.0::DOUBLE) END AS position FROM timed)),
merged AS (
  SELECT src, start, sum(words)::BIGINT AS taken, count(*) AS n_copies, min(position) AS first_position, min(place) AS first_place, max(place) AS last_place FROM mixed GROUP BY src, start)
SELECT doc_id, size, source_size, target, coalesce(m.taken, 0) AS taken, coalesce(n_copies, 0) AS n_copies, round(first_position, 6) AS first_position,
       coalesce(first_place, 0) AS first_place, coalesce(last_place, 0) AS last_place
FROM taking t LEFT JOIN merged m ON t.src = m.src AND t.start = m.start AND w0 > 0
"""


def _lloyd(entries: int, rounds: int) -> str:
    """SQL of the assignments and codebooks of all rounds: ``at{r}`` assigns to ``book{r}``."""
    nearest = """at{r} AS (
  SELECT rid, part, min_by(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT rid, p.part, entry, list_sum(list_transform(generate_series(1, len(p.v)), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::BIGINT AS d FROM parted p JOIN book{r} b ON p.part = b.part) GROUP BY rid, part)"""
    retrained = """sums{r} AS (
  SELECT part, entry, i, sum(x)::BIGINT AS s, count(*) AS c FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM at{q} JOIN parted USING (rid, part)) GROUP BY part, entry, i),
book{r} AS (
  SELECT part, entry, coalesce(w, v) AS v FROM book{q} LEFT JOIN (SELECT part, entry, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY i) AS w FROM sums{r} GROUP BY part, entry) USING (part, entry))"""
    steps = [f"book0 AS (SELECT part, rid - 1 AS entry, v FROM parted WHERE rid <= {entries})", nearest.format(r=0)]
    for r in range(1, rounds + 1):
        steps += [retrained.format(r=r, q=r - 1), nearest.format(r=r)]
    return ",\n".join(steps)


ORACLES["op12_cover_codes"] = r"""
WITH kept AS (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parted AS (
  SELECT rid, part, list_transform(embedding[(part * len(embedding)) // 16 + 1 : ((part + 1) * len(embedding)) // 16], lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM kept, (SELECT unnest(range(16)) AS part)),
""" + _lloyd(64, 2) + r""",
coded AS (
  SELECT rid, string_agg(lpad(format('{:x}', entry), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM at2 GROUP BY rid),
named AS (SELECT vec_id, label, code, error FROM kept JOIN coded USING (rid)),
sha AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM named, sha
"""

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT lang, pid, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, text, row_number() OVER () AS pid FROM documents)),
worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces WHERE regexp_matches(piece, '[^\x20\x09]')),
grams AS (
  SELECT lang, w[i : i + m - 1] AS g, m FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM worded, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
f AS (SELECT lang, m, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f FROM grams GROUP BY lang, m, array_to_string(g, ' ') HAVING count(*) >= 100),
gone AS (
  SELECT DISTINCT s.lang, s.phrase FROM (
    SELECT lang, f, m, array_to_string(g[i : j], ' ') AS phrase FROM (
      SELECT *, unnest(range(i, m + 1)) AS j FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM f WHERE m > 2))) l
  JOIN f s ON s.lang = l.lang AND s.phrase = l.phrase AND s.m < l.m AND 100 * l.f >= 100 * s.f),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, n, k, l.f AS l, r.f AS r, ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m >= 2) c
  JOIN totals USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.g[1 : k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.g[k + 1 : c.m], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score, k AS cut FROM ranked WHERE rank <= 2000
"""
