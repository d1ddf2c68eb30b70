"""DuckDB SQL that computes the same result as each registered query.

Written independently from the Spark code, against the pre-registered
views (documents, conversations, benchmark, embeddings, labels, ...).
Column names match the Spark output.
"""

from __future__ import annotations

from math import sqrt

# The stop words of the quality rules and of the language score.
GOPHER_STOP_WORDS = ["the", "be", "to", "of", "and", "that", "have", "with"]
LANGUAGE_STOP_WORDS = {
    "en": ["the", "and", "of", "to", "is", "in", "that", "it", "with", "for"],
    "fr": ["le", "la", "les", "et", "des", "un", "une", "du", "est", "pour"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den"],
    "es": ["el", "los", "las", "y", "es", "una", "que", "del", "por", "con"],
}

WS = r"[ \t\n\x0B\f\r]+"
TEST_KEYWORDS = ["worthless", "license", "und"]


def _list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{WS}'), lambda x: x <> '')"


def _whole_word(expr: str, keywords: list[str]) -> str:
    alts = "|".join(keywords)
    return (f"regexp_matches({expr}, "
            f"'(^|[^\\p{{L}}\\p{{N}}_])({alts})($|[^\\p{{L}}\\p{{N}}_])')")


def gopher_reason_cte(src: str = "documents") -> str:
    """CTE chain ending in ``g(doc_id, reason)``."""
    return f"""
g0 AS (SELECT doc_id, coalesce(text, '') AS t FROM {src}),
g1 AS (SELECT doc_id, t, {_words('t')} AS ws, string_split(t, chr(10)) AS lines FROM g0),
g2 AS (SELECT doc_id, t, ws, lines,
              list_filter(ws, lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')) AS nsw FROM g1),
g3 AS (SELECT doc_id, len(ws) AS n_words, len(nsw) AS n_nsw,
         list_sum(list_transform(nsw, lambda x: length(x))) / nullif(len(nsw), 0) AS avg_len,
         length(t) - length(replace(t, '#', '')) AS n_hash,
         (length(t) - length(replace(t, '...', ''))) / 3
           + (length(t) - length(replace(t, '…', ''))) AS n_ell,
         len(lines) AS n_lines,
         len(list_filter(lines, lambda l: starts_with(ltrim(l), '•') OR starts_with(ltrim(l), '-'))) AS bullets,
         len(list_filter(lines, lambda l: ends_with(rtrim(l), '...') OR ends_with(rtrim(l), '…'))) AS ell_lines,
         len(list_filter(ws, lambda x: regexp_matches(x, '\\p{{L}}'))) AS alpha,
         len(list_distinct(list_filter(ws, lambda x: list_contains({_list(GOPHER_STOP_WORDS)}, x)))) AS n_stop
       FROM g2),
g AS (SELECT doc_id, CASE
         WHEN n_nsw < 50 THEN 'short_doc'
         WHEN n_nsw > 100000 THEN 'long_doc'
         WHEN avg_len < 3.0::DOUBLE THEN 'avg_word_low'
         WHEN avg_len > 10.0::DOUBLE THEN 'avg_word_high'
         WHEN n_hash > 0.1::DOUBLE * n_words THEN 'hash_ratio'
         WHEN n_ell > 0.1::DOUBLE * n_words THEN 'ellipsis_ratio'
         WHEN bullets > 0.9::DOUBLE * n_lines THEN 'bullet_lines'
         WHEN ell_lines > 0.3::DOUBLE * n_lines THEN 'ellipsis_lines'
         WHEN alpha < 0.8::DOUBLE * n_words THEN 'alpha_words'
         WHEN n_stop < 2 THEN 'stop_words'
       END AS reason FROM g3)"""


def _language_sql() -> str:
    parts = []
    for lang, sw in LANGUAGE_STOP_WORDS.items():
        parts.append(f"len(list_filter(ws, lambda x: list_contains({_list(sw)}, x)))"
                     f" / nullif(len(ws), 0) AS s_{lang}")
    langs = list(LANGUAGE_STOP_WORDS)
    best = "greatest(" + ", ".join(f"s_{l}" for l in langs) + ")"
    pred = "CASE " + " ".join(f"WHEN s_{l} = {best} THEN '{l}'" for l in langs) + " END"
    return f"""
WITH a AS (SELECT doc_id, lang, {_words('lower(coalesce(text, \'\'))')} AS ws FROM documents),
b AS (SELECT doc_id, lang, {', '.join(parts)} FROM a),
c AS (SELECT doc_id, lang, {pred} AS predicted, coalesce({best}, 0.0) AS score FROM b)
SELECT doc_id, lang, predicted, round(score, 6) AS score FROM c
WHERE predicted IN ('en', 'de') AND score >= 0.05"""


ORACLES: dict[str, str] = {
    "read_corpus": "SELECT doc_id AS id, coalesce(text, '') AS text FROM documents WHERE lang = 'en'",
    "take_first": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 100",
    "preview": """SELECT doc_id, CASE WHEN coalesce(text, '') <> ''
                    THEN substring(text, 1, 100) || '...' ELSE '[No Text Found]' END AS snippet
                  FROM documents""",
    "tag_source": "SELECT doc_id, 'web' AS source FROM documents",
    "map_project": "SELECT '### ' || role || ': ' || coalesce(text, '') AS text FROM conversations",
    "gopher_filter": f"WITH {gopher_reason_cte()} SELECT doc_id FROM g WHERE reason IS NULL",
    "gopher_reasons": f"""WITH {gopher_reason_cte()}
        SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM g GROUP BY 1""",
    "split_kept_removed": f"""WITH {gopher_reason_cte()}
        SELECT doc_id, reason IS NULL AS kept, reason FROM g""",
    "language_filter": _language_sql(),
    "topic_extract": f"""SELECT doc_id, text FROM documents
        WHERE {_whole_word("lower(coalesce(text, ''))", TEST_KEYWORDS)}
        ORDER BY doc_id LIMIT 100""",
    "topic_hits": """
        SELECT k.keyword, count(d.doc_id) AS n_docs
        FROM (VALUES """ + ", ".join(f"('{k}')" for k in TEST_KEYWORDS) + """) k(keyword)
        LEFT JOIN documents d
          ON regexp_matches(lower(coalesce(d.text, '')),
                            '(^|[^\\p{L}\\p{N}_])' || k.keyword || '($|[^\\p{L}\\p{N}_])')
        GROUP BY k.keyword""",
}

NL = "chr(10)"

_MC = f"""mc AS (SELECT item_id, item_id % 3 AS subject, text AS question,
       {_words("coalesce(text, '')")}[1:4] AS choices, (item_id % 4)::INTEGER AS answer
     FROM benchmark)"""
_MMLU = f"""mm AS (SELECT item_id, subject,
       CASE WHEN len(choices) <= 4 THEN 'Question: ' || coalesce(question, '') || {NL}
         || array_to_string(list_transform(choices, lambda c, i: ['A','B','C','D'][i] || '. ' || c || {NL}), '')
         || 'Answer:' END AS prompt,
       CASE WHEN len(choices) <= 4 AND answer BETWEEN 0 AND 3 THEN ['A','B','C','D'][answer + 1] END AS label
     FROM mc)"""
_WA = f"""wa AS (SELECT item_id, text AS question, 'work' || {NL} || '#### ' || item_id AS answer
     FROM benchmark),
gs AS (SELECT item_id, 'Question: ' || coalesce(question, '') || {NL} || 'Answer:' AS prompt,
       CASE WHEN contains(answer, '####') THEN regexp_extract(answer, '####\\s*(.*)', 1) END AS answer
     FROM wa)"""


def _per_conv(line: str, suffix: str = "''") -> str:
    return f"""SELECT conv_id, string_agg({line}, '' ORDER BY turn) || {suffix} AS text
               FROM conversations GROUP BY conv_id"""


ORACLES.update({
    "format_instruction": f"""
        WITH u AS (SELECT conv_id, turn, text AS instruction FROM conversations WHERE role = 'user'),
        a AS (SELECT conv_id, turn - 1 AS turn, text AS output FROM conversations WHERE role = 'assistant'),
        s AS (SELECT conv_id, arg_min(text, turn) AS input FROM conversations
              WHERE role = 'system' GROUP BY conv_id)
        SELECT u.conv_id, u.turn,
          CASE WHEN coalesce(s.input, '') <> ''
            THEN '### Instruction:' || {NL} || coalesce(u.instruction, '') || {NL} || {NL}
                 || '### Input:' || {NL} || coalesce(s.input, '') || {NL} || {NL}
                 || '### Response:' || {NL} || coalesce(a.output, '')
            ELSE '### Instruction:' || {NL} || coalesce(u.instruction, '') || {NL} || {NL}
                 || '### Response:' || {NL} || coalesce(a.output, '') END AS text
        FROM u JOIN a USING (conv_id, turn) LEFT JOIN s USING (conv_id)""",
    "format_roles": _per_conv(
        f"CASE WHEN role = 'user' THEN '### Human: ' ELSE '### Assistant: ' END"
        f" || coalesce(text, '') || {NL}"),
    "chat_custom": _per_conv(
        f"'### ' || upper(left(role, 1)) || lower(substring(role, 2)) || ': '"
        f" || coalesce(text, '') || {NL}", "'### Assistant: '"),
    "chat_chatml": _per_conv(
        f"'<|im_start|>' || role || {NL} || coalesce(text, '') || '<|im_end|>' || {NL}",
        f"'<|im_start|>assistant' || {NL}"),
    "format_mmlu": f"WITH {_MC}, {_MMLU} SELECT item_id, prompt, label FROM mm",
    "format_gsm8k": f"WITH {_WA} SELECT item_id, prompt, answer FROM gs",
    "extract_answer": f"WITH {_WA} SELECT item_id, answer FROM gs",
    "few_shot": f"""WITH {_MC}, {_MMLU},
        r AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY item_id) AS rn FROM mm),
        s AS (SELECT subject, string_agg(prompt || ' ' || coalesce(label, '') || {NL} || {NL}, ''
                                         ORDER BY rn) AS shots
              FROM r WHERE rn <= 5 GROUP BY subject)
        SELECT r.item_id, r.subject, s.shots || r.prompt AS prompt, r.label
        FROM r JOIN s USING (subject) WHERE r.rn > 5""",
    "few_shot_gsm8k": f"""WITH {_WA},
        r AS (SELECT *, row_number() OVER (ORDER BY item_id) AS rn FROM gs),
        s AS (SELECT string_agg(prompt || ' ' || coalesce(answer, '') || {NL} || {NL}, ''
                                ORDER BY rn) AS shots FROM r WHERE rn <= 3)
        SELECT r.item_id, s.shots || r.prompt AS prompt, r.answer AS label
        FROM r, s WHERE r.rn > 3""",
})


# --- deduplication ---------------------------------------------------------
_NORM = "trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'))"
def _shingles_cte(src: str = "documents") -> str:
    return f"""nw AS (SELECT doc_id, list_filter(string_split({_NORM}, ' '), lambda x: x <> '') AS ws
                FROM {src}),
ni AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM nw),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM ni)"""


_SHINGLES = _shingles_cte()
_SIG = f"""{_SHINGLES},
hv AS (SELECT DISTINCT doc_id, ('0x' || substr(md5(s), 1, 8))::BIGINT % 2147483647 AS h FROM sh),
co AS (SELECT j,
         ('0x' || substr(md5('minhash:1:' || j || ':a'), 1, 8))::BIGINT % 2147483646 + 1 AS a,
         ('0x' || substr(md5('minhash:1:' || j || ':b'), 1, 8))::BIGINT % 2147483647 AS b
       FROM range(0, 160) r(j)),
mn AS (SELECT hv.doc_id, co.j, min((co.a * hv.h + co.b) % 2147483647) AS v
       FROM hv, co GROUP BY hv.doc_id, co.j),
bk AS (SELECT doc_id, (j // 8)::INTEGER AS band, md5(string_agg(v::VARCHAR, ' ' ORDER BY j)) AS bucket
       FROM mn GROUP BY doc_id, j // 8),
lb AS (SELECT band, bucket, count(*) AS n_docs, min(doc_id) AS min_doc_id
       FROM bk GROUP BY band, bucket HAVING count(*) > 1),
ed AS (SELECT DISTINCT bk.doc_id AS src, lb.min_doc_id AS dst
       FROM bk JOIN lb USING (band, bucket) WHERE bk.doc_id <> lb.min_doc_id)"""
_CLUSTERS = f"""WITH RECURSIVE {_SIG},
un AS (SELECT src AS a, dst AS b FROM ed UNION SELECT dst, src FROM ed),
reach(node, root) AS (
  SELECT a, a FROM un
  UNION
  SELECT un.b, reach.root FROM reach JOIN un ON un.a = reach.node),
cl AS (SELECT node AS doc_id, min(root) AS cluster_id FROM reach GROUP BY node)"""

ORACLES.update({
    "exact_dedup": f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY CASE WHEN {_NORM} = '' THEN ':' || coalesce(text, '') ELSE {_NORM} END",
    "shingles": f"""WITH {_SHINGLES}
        SELECT nw.doc_id, count(sh.s) AS n_shingles FROM nw LEFT JOIN sh USING (doc_id)
        GROUP BY nw.doc_id""",
    "minhash_signature": f"""WITH {_SIG}
        SELECT doc_id, string_agg(v::VARCHAR, ' ' ORDER BY j) AS signature FROM mn GROUP BY doc_id""",
    "lsh_buckets": f"WITH {_SIG} SELECT band, bucket, n_docs, min_doc_id FROM lb",
    "candidate_edges": f"WITH {_SIG} SELECT src, dst FROM ed",
    "dup_clusters": f"{_CLUSTERS} SELECT doc_id, cluster_id FROM cl",
    "minhash_dedup": f"""{_CLUSTERS} SELECT doc_id FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM cl WHERE doc_id <> cluster_id)""",
    "dup_removed": f"{_CLUSTERS} SELECT doc_id, cluster_id FROM cl WHERE doc_id <> cluster_id",
})


# --- tokens ----------------------------------------------------------------
_BYTES = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::INTEGER)"
_BYTE_IDS = f"byt AS (SELECT doc_id, {_BYTES} AS ids FROM documents)"


def _bpe_ctes(n_rounds: int, src: str = "documents") -> str:
    """Unrolled training: symbols are chr(id + 256); each round counts
    adjacent pairs, takes the most frequent (earliest on ties) and replaces."""
    ctes = [f"""s0 AS MATERIALIZED (SELECT doc_id, array_to_string(list_transform({_BYTES},
                  lambda b: chr(b + 256)), '') AS s FROM {src})"""]
    for r in range(n_rounds):
        ctes.append(f"""p{r} AS MATERIALIZED (SELECT pair, count(*) AS n, min({{'d': doc_id, 'i': i}}) AS first
              FROM (SELECT doc_id, i, l[i] || l[i + 1] AS pair
                    FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i
                          FROM (SELECT doc_id, string_split(s, '') AS l FROM s{r})))
              GROUP BY pair),
t{r} AS MATERIALIZED (SELECT {r} AS rank, pair FROM p{r} ORDER BY n DESC, first ASC LIMIT 1),
s{r + 1} AS MATERIALIZED (SELECT doc_id, coalesce(replace(s, (SELECT pair FROM t{r}), chr({256 + r} + 256)), s) AS s
              FROM s{r})""")
    merges = " UNION ALL ".join(f"SELECT * FROM t{r}" for r in range(n_rounds))
    ctes.append(f"""mg AS (SELECT rank::INTEGER AS rank,
                      (unicode(substr(pair, 1, 1)) - 256)::INTEGER AS left_id,
                      (unicode(substr(pair, 2, 1)) - 256)::INTEGER AS right_id,
                      (256 + rank)::INTEGER AS new_id FROM ({merges}))""")
    ctes.append(f"""enc AS (SELECT doc_id, CASE WHEN s = '' THEN []::INTEGER[] ELSE
                      list_transform(string_split(s, ''), lambda c: (unicode(c) - 256)::INTEGER) END AS ids
                    FROM s{n_rounds})""")
    return ",\n".join(ctes)


def _vocab_ctes(n_rounds: int) -> str:
    parts = ["v0 AS (SELECT i::INTEGER AS token_id, printf('%02X', i) AS piece_hex FROM range(0, 256) r(i))"]
    for r in range(n_rounds):
        parts.append(f"""v{r + 1} AS (SELECT * FROM v{r} UNION ALL
            SELECT mg.new_id, l.piece_hex || rr.piece_hex FROM mg
            JOIN v{r} l ON l.token_id = mg.left_id JOIN v{r} rr ON rr.token_id = mg.right_id
            WHERE mg.rank = {r})""")
    return ",\n".join(parts)


ORACLES.update({
    "byte_tokens": f"WITH {_BYTE_IDS} SELECT doc_id, array_to_string(ids, ' ') AS tokens FROM byt",
    "pair_counts": f"""WITH {_BYTE_IDS},
        pr AS (SELECT ids[i] AS left_id, ids[i + 1] AS right_id
               FROM (SELECT ids, unnest(range(1, len(ids))) AS i FROM byt))
        SELECT left_id, right_id, count(*) AS n FROM pr GROUP BY left_id, right_id""",
    "bpe_merge": f"WITH {_bpe_ctes(1)} SELECT doc_id, array_to_string(ids, ' ') AS tokens FROM enc",
    "bpe_train": f"WITH {_bpe_ctes(10)} SELECT rank, left_id, right_id, new_id FROM mg",
    "bpe_encode": f"""WITH {_bpe_ctes(10)}
        SELECT doc_id, len(ids)::BIGINT AS n_tokens, array_to_string(ids, ' ') AS tokens FROM enc""",
    "bpe_decode": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "token_pieces": f"""WITH {_bpe_ctes(10)}, {_vocab_ctes(10)},
        ex AS (SELECT doc_id, unnest(range(0, len(ids))) AS pos, ids FROM enc)
        SELECT ex.doc_id, ex.pos::INTEGER AS pos, ex.ids[ex.pos + 1] AS token_id, v.piece_hex
        FROM ex JOIN v10 v ON v.token_id = ex.ids[ex.pos + 1]""",
    "token_stats": """SELECT lang, round(avg(strlen(coalesce(text, ''))), 2) AS avg_tokens,
        max(strlen(coalesce(text, '')))::BIGINT AS max_tokens,
        min(strlen(coalesce(text, '')))::BIGINT AS min_tokens FROM documents GROUP BY lang""",
    "token_histogram": """SELECT m.max_len::INTEGER AS max_len,
        count(d.doc_id) AS n_fit,
        round(count(d.doc_id) / (SELECT count(*) FROM documents), 6) AS share
        FROM (VALUES (2048), (4096), (32768), (131072)) m(max_len)
        LEFT JOIN documents d ON strlen(coalesce(d.text, '')) <= m.max_len GROUP BY m.max_len""",
    "truncate_pad": f"""WITH {_BYTE_IDS},
        tp AS (SELECT doc_id, ids[1:256] AS cut FROM byt)
        SELECT doc_id,
          array_to_string(list_concat(cut, list_transform(range(256 - len(cut)), lambda x: 256)), ' ') AS input_ids,
          array_to_string(list_concat(list_transform(cut, lambda x: 1),
                                      list_transform(range(256 - len(cut)), lambda x: 0)), ' ') AS attention_mask
        FROM tp""",
    "lm_labels": f"""WITH {_BYTE_IDS},
        tp AS (SELECT doc_id, ids[1:256] AS cut FROM byt)
        SELECT doc_id, array_to_string(list_transform(
          list_concat(cut, list_transform(range(256 - len(cut)), lambda x: 256)),
          lambda x: CASE WHEN x = 256 THEN -100 ELSE x END), ' ') AS labels FROM tp""",
    "append_eos": """SELECT doc_id, (strlen(coalesce(text, '')) + 1)::BIGINT AS n_tokens, 256 AS last_id
        FROM documents""",
    "pack_tokens": f"""WITH {_BYTE_IDS},
        tok AS (SELECT doc_id, list_append(ids, 256) AS ids FROM byt),
        off AS (SELECT doc_id, ids, coalesce(sum(len(ids)) OVER (ORDER BY doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM tok),
        flat AS (SELECT o + i - 1 AS gpos, ids[i] AS t FROM (SELECT o, ids, unnest(range(1, len(ids) + 1)) AS i FROM off)),
        tot AS (SELECT count(*) AS total FROM flat)
        SELECT (gpos // 1024)::BIGINT AS block_id, string_agg(t::VARCHAR, ' ' ORDER BY gpos) AS tokens
        FROM flat, tot WHERE gpos < (total // 1024) * 1024 GROUP BY gpos // 1024""",
    "pack_report": """WITH t AS (SELECT count(*) AS n_docs, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS total FROM documents)
        SELECT n_docs, total AS total_tokens, (total // 1024)::BIGINT AS n_blocks,
               (total % 1024)::BIGINT AS dropped_tokens FROM t""",
})


# --- mixing ----------------------------------------------------------------
# Half and eight tenths of 2^32: web below the first, code from the second on.
_T = [2147483648, 3435973837]
_GROUP = ("CASE WHEN TRY_CAST(substr(source, 4) AS INTEGER) < 10 THEN 'web' "
          "WHEN TRY_CAST(substr(source, 4) AS INTEGER) < 16 THEN 'knowledge' ELSE 'code' END")
_MIX = f"""dr AS (SELECT r.pos, CASE WHEN u < {_T[0]} THEN 'web' WHEN u < {_T[1]} THEN 'knowledge' ELSE 'code' END AS source
       FROM (SELECT pos, ('0x' || substr(md5('42:' || pos), 1, 8))::BIGINT AS u
             FROM range(0, (SELECT count(*) - 2 FROM documents)) r(pos)) r),
rd AS (SELECT pos, source, row_number() OVER (PARTITION BY source ORDER BY pos) AS rk FROM dr),
sd AS (SELECT doc_id, {_GROUP} AS source FROM documents),
rs AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rk,
              count(*) OVER (PARTITION BY source) AS n FROM sd),
jn AS (SELECT rd.pos, rd.source, rs.doc_id, rs.rk = rs.n AS last FROM rd JOIN rs USING (source, rk)),
mx AS (SELECT pos, source, doc_id FROM jn WHERE pos <= (SELECT min(pos) FROM jn WHERE last))"""

ORACLES.update({
    "mix_sources": f"WITH {_MIX} SELECT pos, source, doc_id FROM mx",
    "seeded_shuffle": """SELECT row_number() OVER (ORDER BY ('0x' || substr(md5('42:shuffle:' || doc_id), 1, 15))::BIGINT,
                                doc_id) - 1 AS pos, doc_id FROM documents""",
    "mix_report": f"""WITH {_MIX},
        fs AS (SELECT source FROM mx ORDER BY ('0x' || substr(md5('42:shuffle:' || pos), 1, 15))::BIGINT, pos
               LIMIT 1000)
        SELECT source, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM fs), 2) AS pct
        FROM fs GROUP BY source""",
})

# --- vectors ---------------------------------------------------------------
_AB = """ab AS (SELECT e.vec_id, e.label, e.embedding, g.m / 127.0 AS scale
        FROM embeddings e JOIN (SELECT label, max(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE)))) AS m
                                FROM embeddings GROUP BY label) g USING (label)),
abq AS (SELECT vec_id, label, embedding, scale,
        list_transform(embedding, lambda x: greatest(-127.0, least(127.0,
            coalesce(round_even(x::DOUBLE / nullif(scale, 0.0), 0), 0.0)))::TINYINT) AS q FROM ab)"""
_ZP = """zg AS (SELECT label, max(list_max(list_transform(embedding, lambda x: x::DOUBLE))) AS mx,
               min(list_min(list_transform(embedding, lambda x: x::DOUBLE))) AS mn FROM embeddings GROUP BY label),
zs AS (SELECT e.vec_id, e.label, e.embedding, zg.mn,
        CASE WHEN zg.mx - zg.mn = 0 THEN 1.0 ELSE zg.mx - zg.mn END / 255.0 AS scale
        FROM embeddings e JOIN zg USING (label)),
zpq AS (SELECT vec_id, label, embedding, scale, round_even(-mn / scale, 0) AS zero_point FROM zs),
zq AS (SELECT vec_id, label, embedding, scale, zero_point,
        list_transform(embedding, lambda x: greatest(0.0, least(255.0,
            round_even(x::DOUBLE / scale + zero_point, 0)))::SMALLINT) AS q FROM zpq)"""
_REST = f"""{_AB}, {_ZP},
rst AS (SELECT vec_id, label, embedding, 'absmax' AS method,
               list_transform(q, lambda x: x::DOUBLE * scale) AS vals FROM abq
        UNION ALL
        SELECT vec_id, label, embedding, 'zeropoint' AS method,
               list_transform(q, lambda x: (x::DOUBLE - zero_point) * scale) AS vals FROM zq)"""

_N_OPT = 0.079 * sqrt(1e21)
_D_OPT = 2.1 * sqrt(1e21)

ORACLES.update({
    "quantize_absmax": f"WITH {_AB} SELECT vec_id, scale, array_to_string(q, ' ') AS q FROM abq",
    "quantize_zeropoint": f"""WITH {_ZP}
        SELECT vec_id, scale, zero_point, array_to_string(q, ' ') AS q FROM zq""",
    "dequantize": f"""WITH {_REST}
        SELECT vec_id, method, (i - 1)::INTEGER AS idx, vals[i] AS value
        FROM (SELECT vec_id, method, vals, unnest(range(1, len(vals) + 1)) AS i FROM rst)""",
    "quantize_error": f"""WITH {_REST},
        per AS (SELECT label, method,
                  list_sum(list_transform(range(1, len(vals) + 1),
                           lambda i: pow(embedding[i]::DOUBLE - vals[i], 2))) AS se,
                  len(embedding) AS n FROM rst)
        SELECT label, method, round(sum(se) / sum(n), 12) AS mse FROM per GROUP BY label, method""",
    "embedding_lookup": f"""WITH {_BYTE_IDS},
        ex AS (SELECT doc_id, unnest(range(0, len(ids))) AS pos, ids FROM byt),
        nv AS (SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm
               FROM embeddings)
        SELECT ex.doc_id, ex.pos::INTEGER AS pos, nv.vec_id, nv.norm
        FROM ex JOIN nv ON nv.vec_id = ex.ids[ex.pos + 1]""",
    "token_budget": f"""WITH t AS (SELECT {_GROUP} AS source, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS tokens
                          FROM documents GROUP BY 1),
        s AS (SELECT * FROM (VALUES ('web', 0.5), ('knowledge', 0.3), ('code', 0.2)) v(source, share))
        SELECT t.source, t.tokens,
          round({_D_OPT!r}::DOUBLE * s.share::DOUBLE, 3) AS target_tokens,
          round({_D_OPT!r}::DOUBLE * s.share::DOUBLE / t.tokens, 6) AS epochs,
          round({406.4 / _N_OPT ** 0.34!r}::DOUBLE + 410.7::DOUBLE / pow(t.tokens::DOUBLE, 0.28::DOUBLE) + 1.69::DOUBLE, 6) AS loss
        FROM t JOIN s USING (source)""",
})

ORACLES.update({
    "jsonl_roundtrip": "SELECT doc_id, coalesce(text, '') AS text, lang, source, n_chars FROM documents",
    "stream_filter": ORACLES["split_kept_removed"],
    "flagship": f"""WITH RECURSIVE {gopher_reason_cte()}, kept AS (SELECT d.doc_id, d.text FROM documents d
            JOIN g USING (doc_id) WHERE g.reason IS NULL),
        {_CLUSTERS.replace("WITH RECURSIVE ", "").replace(_SHINGLES, _shingles_cte("kept"))},
        cur AS (SELECT doc_id, text FROM kept
                WHERE doc_id NOT IN (SELECT doc_id FROM cl WHERE doc_id <> cluster_id)),
        t AS (SELECT count(*) AS n_docs, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS total FROM cur)
        SELECT n_docs, total AS total_tokens, (total // 1024)::BIGINT AS n_blocks,
               (total % 1024)::BIGINT AS dropped_tokens, (total // 1024)::BIGINT AS n_packed FROM t""",
})


def _chat_tokenized_sql(n_rounds: int = 10) -> str:
    """ChatML text per conversation → byte symbols → special markers as
    reserved ids → the merges learned on documents, applied in order."""
    specials = {"<|endoftext|>": 256 + n_rounds, "<|im_start|>": 257 + n_rounds,
                "<|im_end|>": 258 + n_rounds}
    line = f"'<|im_start|>' || role || {NL} || coalesce(text, '') || '<|im_end|>' || {NL}"
    sym = f"array_to_string(list_transform({_BYTES}, lambda b: chr(b + 256)), '')"
    expr = "s"
    for sp, tid in specials.items():
        enc = "".join(chr(ord(c) + 256) for c in sp)
        expr = f"replace({expr}, '{enc}', chr({tid + 256}))"
    for r in range(n_rounds):
        expr = f"replace({expr}, (SELECT pair FROM t{r}), chr({256 + r + 256}))"
    return f"""WITH {_bpe_ctes(n_rounds)},
        ct AS (SELECT conv_id, string_agg({line}, '' ORDER BY turn) || '<|im_start|>assistant' || {NL} AS text
               FROM conversations GROUP BY conv_id),
        cs AS (SELECT conv_id, {sym} AS s FROM ct),
        ce AS (SELECT conv_id, {expr} AS s FROM cs),
        ci AS (SELECT conv_id, list_transform(string_split(s, ''), lambda c: (unicode(c) - 256)::INTEGER) AS ids
               FROM ce)
        SELECT conv_id, len(ids)::BIGINT AS n_tokens, array_to_string(ids, ' ') AS tokens FROM ci"""


ORACLES["chat_tokenized"] = _chat_tokenized_sql()

_T_ = "coalesce(text, '')"
_CASES = {
    "avg_word_low": f"{_T_} || ' ' || repeat('a b ', length({_T_}) + 40)",
    "avg_word_high": f"{_T_} || ' ' || repeat(repeat('abcdefghij', 6) || ' ', 60 + length({_T_}) // 8)",
    "ellipsis_ratio": f"{_T_} || ' ' || repeat('word... and the ', 30 + length({_T_}) // 8)",
    "bullet_lines": f"repeat('- the words of a longlist' || chr(10), 20) || '- ' || replace({_T_}, chr(10), chr(10) || '- ')",
    "ellipsis_lines": f"repeat('the long words of one line and of the next lines that go on ...' || chr(10), 10) || replace({_T_}, chr(10), ' ...' || chr(10)) || ' ...'",
    "stop_words": f"repeat('the word ', 40) || regexp_replace({_T_}, '[tbohwd]', 'x', 'g')",
}


def _judged_cases(cases: dict[str, str], most_words: int = 100000) -> str:
    rows = " UNION ALL ".join(f"SELECT '{rule}:' || doc_id AS doc_id, {text} AS text FROM documents" for rule, text in cases.items())
    judged = gopher_reason_cte("cases").replace("n_nsw > 100000", f"n_nsw > {most_words}")
    return f"WITH cases AS ({rows}), {judged} SELECT split_part(doc_id, ':', 2)::BIGINT AS doc_id, split_part(doc_id, ':', 1) AS rule, reason FROM g"


ORACLES["gopher_rule_cases"] = f"SELECT * FROM ({_judged_cases(_CASES)}) UNION ALL SELECT * FROM ({_judged_cases({'long_doc': _T_}, 200)})"
ORACLES["kept_removed_sinks"] = ORACLES["split_kept_removed"]
ORACLES["chatml_messages"] = ORACLES["chat_chatml"]
ORACLES["chat_roundtrip"] = ORACLES["chat_chatml"]
ORACLES["truncate"] = f"WITH {_BYTE_IDS} SELECT doc_id, array_to_string(ids[1:512], ' ') AS input_ids FROM byt"

ORACLES["language_select"] = "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de')"


def _bpe_word_sql(n_rounds: int) -> str:
    """Word-chunk training: each text is cut before every space (the space
    starts the next chunk); pairs stay inside a chunk; ties go to the
    earliest (doc, chunk, position)."""
    sym = ("array_to_string(list_transform(list_transform(regexp_extract_all(hex(encode(w)), '..'),"
           " lambda h: ('0x' || h)::INTEGER), lambda b: chr(b + 256)), '')")
    ctes = [f"""wp AS (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS parts FROM documents),
wc AS (SELECT doc_id, k, CASE WHEN k = 1 THEN parts[k] ELSE ' ' || parts[k] END AS w
       FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS k FROM wp)),
s0 AS MATERIALIZED (SELECT doc_id, k, {sym} AS s FROM wc)"""]
    for r in range(n_rounds):
        ctes.append(f"""p{r} AS MATERIALIZED (SELECT pair, count(*) AS n, min({{'d': doc_id, 'k': k, 'i': i}}) AS first
              FROM (SELECT doc_id, k, i, l[i] || l[i + 1] AS pair
                    FROM (SELECT doc_id, k, l, unnest(range(1, len(l))) AS i
                          FROM (SELECT doc_id, k, string_split(s, '') AS l FROM s{r})))
              GROUP BY pair),
t{r} AS MATERIALIZED (SELECT {r} AS rank, pair FROM p{r} ORDER BY n DESC, first ASC LIMIT 1),
s{r + 1} AS MATERIALIZED (SELECT doc_id, k, coalesce(replace(s, (SELECT pair FROM t{r}), chr({256 + r} + 256)), s) AS s
              FROM s{r})""")
    merges = " UNION ALL ".join(f"SELECT * FROM t{r}" for r in range(n_rounds))
    return "WITH " + ",\n".join(ctes) + f"""
SELECT rank::INTEGER AS rank, (unicode(substr(pair, 1, 1)) - 256)::INTEGER AS left_id,
       (unicode(substr(pair, 2, 1)) - 256)::INTEGER AS right_id, (256 + rank)::INTEGER AS new_id
FROM ({merges})"""


ORACLES["bpe_train_words"] = _bpe_word_sql(10)


# --- long keyword lists, percentiles ------------------------------------------
_WORDS_OF = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+')"
_KEYWORDS = f"kw AS (SELECT DISTINCT unnest({_WORDS_OF}) AS keyword FROM benchmark)"
ORACLES["topic_hits_many"] = f"""WITH {_KEYWORDS},
    held AS (SELECT DISTINCT rid, unnest(w) AS keyword FROM (SELECT row_number() OVER () AS rid, {_WORDS_OF} AS w FROM documents))
    SELECT kw.keyword, count(held.rid) AS n_docs FROM kw LEFT JOIN held ON held.keyword = kw.keyword GROUP BY kw.keyword"""
ORACLES["topic_extract_many"] = f"""WITH {_KEYWORDS}
    SELECT doc_id, text FROM documents
    WHERE list_has_any({_WORDS_OF}, (SELECT coalesce(list(keyword), []) FROM kw WHERE length(keyword) >= 10))"""
ORACLES["token_percentiles"] = """SELECT lang, p::DOUBLE AS p, count(*) AS n, true AS within_bound
    FROM documents, (VALUES (0.05), (0.25), (0.5), (0.75), (0.95), (0.99)) v(p) GROUP BY lang, p"""

ORACLES["take_first_progressive"] = ORACLES["take_first"]
ORACLES["topic_extract_progressive"] = ORACLES["topic_extract"]


# --- language profiles ----------------------------------------------------------
_LETTER_WORDS = "list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}]+', ' ', 'g'), ' '), lambda x: x <> '')"
_GRAMS = """SELECT rid, lang, substr('_' || w || '_', i, m) AS gram FROM (
    SELECT rid, lang, w, m, unnest(range(1, length(w) + 4 - m)) AS i FROM lw, (VALUES (2), (3)) t(m))
  UNION ALL SELECT rid, lang, unnest(string_split(w, '')) AS gram FROM lw"""
_PROFILES = f"""lw AS (SELECT rid, lang, unnest({_LETTER_WORDS}) AS w FROM (SELECT *, row_number() OVER () AS rid FROM documents)),
gr AS ({_GRAMS}),
pr AS (SELECT lang, gram, rank, n FROM (
  SELECT lang, gram, count(*) AS n, (row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram))::INTEGER AS rank
  FROM gr WHERE lang IS NOT NULL GROUP BY lang, gram) WHERE rank <= 300)"""
_IDENTIFIED = f"""{_PROFILES},
own AS (SELECT * FROM (SELECT rid, gram, row_number() OVER (PARTITION BY rid ORDER BY count(*) DESC, gram) AS place FROM gr GROUP BY rid, gram) WHERE place <= 300),
far AS (SELECT rid, l.lang, sum(coalesce(abs(place - pr.rank), 300))::BIGINT AS distance, count(*)::INTEGER AS n_grams
        FROM own, (SELECT DISTINCT lang FROM pr) l LEFT JOIN pr ON pr.lang = l.lang AND pr.gram = own.gram GROUP BY rid, l.lang),
best AS (SELECT rid, lang AS predicted, distance, n_grams FROM far QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, lang) = 1),
idd AS (SELECT doc_id, predicted, distance, coalesce(n_grams, 0)::INTEGER AS n_grams FROM (SELECT *, row_number() OVER () AS rid FROM documents) LEFT JOIN best USING (rid))"""
ORACLES["language_profiles"] = f"WITH {_PROFILES} SELECT lang, gram, rank, n FROM pr"
ORACLES["language_identify"] = f"WITH {_IDENTIFIED} SELECT doc_id, predicted, distance, n_grams FROM idd"
ORACLES["language_profile_filter"] = f"""WITH {_IDENTIFIED}
    SELECT doc_id, predicted, round(distance / (n_grams * 300), 6) AS distance FROM idd
    WHERE predicted IN ('en', 'de') AND distance / (n_grams * 300) <= 0.7"""
ORACLES["bpe_train_indexed"] = _bpe_word_sql(20)

_SCORED = """sc AS (SELECT length(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g'))::DOUBLE / greatest(length(coalesce(text, '')), 1) AS score, quality AS label
  FROM documents JOIN labels USING (doc_id) WHERE quality IN (0, 1))"""
ORACLES["score_auc"] = f"""WITH {_SCORED},
    per AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM sc GROUP BY score),
    un AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under FROM per)
    SELECT sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg, round(sum(pos * (2 * under + neg))::DOUBLE / (2.0 * sum(pos) * sum(neg)), 9) AS auc FROM un"""
ORACLES["score_confusion"] = f"""WITH {_SCORED}
    SELECT t::DOUBLE AS threshold, count(*) FILTER (score >= t AND label = 1) AS tp, count(*) FILTER (score >= t AND label = 0) AS fp,
           count(*) FILTER (score < t AND label = 0) AS tn, count(*) FILTER (score < t AND label = 1) AS fn
    FROM sc, (VALUES (0.5::DOUBLE), (0.6), (0.7), (0.75), (0.8), (0.85)) v(t) GROUP BY t"""

ORACLES["embedding_lookup_skewed"] = ORACLES["embedding_lookup"].replace("FROM ex JOIN nv", "FROM ex LEFT JOIN nv").replace("nv.vec_id, nv.norm", "ex.ids[ex.pos + 1]::BIGINT AS vec_id, nv.norm")
ORACLES["buffered_shuffle"] = """WITH nm AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
    sl AS (SELECT doc_id, i, CASE WHEN i < 1000 THEN i ELSE ('0x' || substr(md5('42:buffer:' || i), 1, 8))::BIGINT % 1000 END AS slot FROM nm),
    ld AS (SELECT *, lead(i) OVER (PARTITION BY slot ORDER BY i) AS o FROM sl)
    SELECT doc_id, CASE WHEN o IS NOT NULL THEN o - 1000 ELSE greatest((SELECT count(*) FROM nm) - 1000, 0)
      + row_number() OVER (PARTITION BY o IS NULL ORDER BY ('0x' || substr(md5('42:rest:' || slot), 1, 8))::BIGINT, slot) - 1 END AS pos FROM ld"""

ORACLES["stream_sinks"] = ORACLES["split_kept_removed"]
ORACLES["stream_topic"] = f"""SELECT doc_id, text FROM documents WHERE {_whole_word("lower(coalesce(text, ''))", TEST_KEYWORDS)}"""
ORACLES["stream_prompts"] = ORACLES["format_gsm8k"]
ORACLES["dup_clusters_incremental"] = ORACLES["dup_clusters"]
ORACLES["jsonl_source"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
