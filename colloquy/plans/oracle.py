"""DuckDB SQL twins of the registered exact queries (same column names/types).

Idioms: cleaned text is split like MLlib's Tokenizer; doubles are rounded
with integer units, ``floor(x * 10^6 + 0.5) / 10^6``; counts are BIGINT.
"""

from __future__ import annotations

from colloquy.functions.text import ENGLISH_STOP_WORDS

SW = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"
CLEAN = "regexp_replace(lower({t}), '[^a-zA-Z ]', '', 'g')"
TOK = ("(CASE WHEN {c} = '' THEN [''] WHEN rtrim({c}, ' ') = '' THEN []::VARCHAR[] "
       "ELSE string_split(rtrim({c}, ' '), ' ') END)")
FILT = "list_filter({w}, lambda x: NOT list_contains(" + SW + ", x))"


def R6(x: str) -> str:
    """SQL twin of ``r6``."""
    return f"(floor(({x}) * CAST(1000000 AS DOUBLE) + 0.5) / CAST(1000000 AS DOUBLE))"


def RATIO3(a: str, b: str) -> str:
    """SQL twin of ``round_ratio(a, b, 3)``."""
    return (f"(CASE WHEN ({b}) = 0 THEN CAST(0.0 AS DOUBLE) ELSE "
            f"CAST((2000 * ({a}) + ({b})) // (2 * ({b})) AS DOUBLE) / 1000.0 END)")


DOCS = f"""
docs_clean AS (SELECT doc_id, {CLEAN.format(t='text')} AS c FROM documents),
docs_words AS (SELECT doc_id, c, {TOK.format(c='c')} AS words FROM docs_clean),
docs_fw AS (SELECT doc_id, words, {FILT.format(w='words')} AS fw FROM docs_words)
"""

LAB = f"""
lab_clean AS (SELECT d.doc_id, CAST(l.toxic AS DOUBLE) AS labels, l.quality, d.n_chars,
                     {CLEAN.format(t='d.text')} AS c
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
lab_nonempty AS (SELECT * FROM lab_clean WHERE c <> ''),
lab_fw AS (SELECT doc_id, labels, quality, n_chars, {FILT.format(w=TOK.format(c='c'))} AS fw FROM lab_nonempty)
"""

SPLIT = ("(CASE WHEN ('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 100 < 70 THEN 'Train' "
         "WHEN ('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 100 < 80 THEN 'Validation' "
         "ELSE 'Test' END)")

D01 = """
d01 AS (SELECT conv_id,
               string_agg(upper(role[1]) || lower(role[2:]) || ': ' || text, ' ' ORDER BY turn) AS dialogue,
               CAST(count(*) AS BIGINT) AS n_turns
        FROM conversations GROUP BY conv_id)
"""

TOP_STATS = LAB + f""",
cnt AS (SELECT term, count(*) AS term_count FROM (SELECT unnest(fw) AS term FROM lab_fw) GROUP BY term),
top AS (SELECT term AS word FROM cnt ORDER BY term_count DESC, term ASC LIMIT 20),
occ AS (SELECT DISTINCT doc_id, labels, word FROM (SELECT doc_id, labels, unnest(fw) AS word FROM lab_fw)),
agg AS (SELECT t.word,
               CAST(coalesce(sum(CASE WHEN o.labels = 1.0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS scam_count,
               CAST(coalesce(sum(CASE WHEN o.labels = 0.0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS non_scam_count
        FROM top t LEFT JOIN occ o ON o.word = t.word GROUP BY t.word),
stats AS (SELECT word, scam_count, non_scam_count,
                 {RATIO3('scam_count', 'scam_count + non_scam_count')} AS scam_ratio FROM agg)
"""

RULE_PRED = """
p AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN CAST(2.0 AS DOUBLE) ELSE CAST(quality AS DOUBLE) END AS prediction
      FROM labels)
"""


def _pct(u: str, digits: int) -> str:
    if digits == 0:
        return f"CAST({u} AS VARCHAR)"
    s = 10 ** digits
    return f"(CAST({u} // {s} AS VARCHAR) || '.' || lpad(CAST({u} % {s} AS VARCHAR), {digits}, '0'))"


SQL = {
    "label_filter_p01": """
WITH d AS (SELECT doc_id,
                  CASE doc_id % 7 WHEN 0 THEN ' ' || CAST(toxic AS VARCHAR) || ' '
                                  WHEN 1 THEN CAST(toxic AS VARCHAR) || '.0'
                                  WHEN 2 THEN 'x' WHEN 3 THEN '' WHEN 4 THEN NULL
                                  ELSE CAST(toxic AS VARCHAR) END AS labels
           FROM labels)
SELECT doc_id, CAST(trim(labels) AS DOUBLE) AS labels FROM d WHERE trim(labels) IN ('0', '1')
""",
    "labelled_csv_s01": f"""
WITH d AS (SELECT doc.text AS dialogue,
                  CASE l.doc_id % 7 WHEN 0 THEN ' ' || CAST(l.toxic AS VARCHAR) || ' '
                                    WHEN 1 THEN CAST(l.toxic AS VARCHAR) || '.0'
                                    WHEN 2 THEN 'x' WHEN 3 THEN '' WHEN 4 THEN NULL
                                    ELSE CAST(l.toxic AS VARCHAR) END AS labels
           FROM documents doc JOIN labels l ON doc.doc_id = l.doc_id)
SELECT dialogue, CAST(trim(labels) AS DOUBLE) AS labels, {CLEAN.format(t='dialogue')} AS clean_text
FROM d WHERE trim(labels) IN ('0', '1') AND {CLEAN.format(t='dialogue')} <> ''
""",
    "clean_text_p03": f"SELECT doc_id, {CLEAN.format(t='text')} AS clean_text FROM documents",
    "drop_empty_p04": "WITH " + LAB + " SELECT doc_id, labels, c AS clean_text FROM lab_nonempty",
    "tokens_f01": "WITH " + DOCS + " SELECT doc_id, CAST(to_json(words) AS VARCHAR) AS words_json, "
                  "CAST(len(words) AS BIGINT) AS n_words FROM docs_words",
    "stopwords_f02": "WITH " + DOCS + " SELECT doc_id, CAST(to_json(fw) AS VARCHAR) AS filtered_json, "
                     "CAST(len(fw) AS BIGINT) AS n_filtered FROM docs_fw",
    "vocab_f03": "WITH " + DOCS + """,
cnt AS (SELECT term, CAST(count(*) AS BIGINT) AS term_count FROM (SELECT unnest(fw) AS term FROM docs_fw) GROUP BY term),
ranked AS (SELECT term, term_count,
                  CAST(row_number() OVER (ORDER BY term_count DESC, term ASC) - 1 AS BIGINT) AS term_index FROM cnt)
SELECT term, term_count, term_index FROM ranked WHERE term_index < 20000
""",
    "tf_f04": "WITH " + DOCS + """
SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf
FROM (SELECT doc_id, unnest(fw) AS term FROM docs_fw) GROUP BY doc_id, term
""",
    "idf_f05": "WITH " + DOCS + f""",
m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM docs_fw),
dfq AS (SELECT term, CAST(count(*) AS BIGINT) AS doc_freq
        FROM (SELECT doc_id, unnest(list_distinct(fw)) AS term FROM docs_fw) GROUP BY term)
SELECT term, doc_freq, {R6('ln((m.m + 1.0) / (doc_freq + 1.0))')} AS idf FROM dfq, m
""",
    "tfidf_f06": "WITH " + DOCS + f""",
m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM docs_fw),
dfq AS (SELECT term, count(*) AS doc_freq
        FROM (SELECT doc_id, unnest(list_distinct(fw)) AS term FROM docs_fw) GROUP BY term),
idf AS (SELECT term, ln((m.m + 1.0) / (doc_freq + 1.0)) AS idf FROM dfq, m),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(fw) AS term FROM docs_fw) GROUP BY doc_id, term)
SELECT tf.doc_id, tf.term, {R6('tf.tf * idf.idf')} AS tfidf FROM tf JOIN idf ON tf.term = idf.term
""",
    "dialogues_d01": "WITH " + D01 + " SELECT conv_id, dialogue, n_turns FROM d01",
    "hash_split_x01": f"SELECT doc_id, {SPLIT.format(k='doc_id')} AS split FROM documents",
    "split_counts_x02": "WITH " + LAB + f"""
SELECT split, CAST(count(*) AS BIGINT) AS n FROM (SELECT {SPLIT.format(k='doc_id')} AS split FROM lab_nonempty) GROUP BY split
""",
    "word_assoc_a02": "WITH " + TOP_STATS + " SELECT word, scam_count, non_scam_count, scam_ratio FROM stats",
    "word_stats_rule_a04": "WITH " + TOP_STATS + """,
m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM lab_fw),
dfq AS (SELECT term, count(*) AS doc_freq FROM (SELECT doc_id, unnest(list_distinct(fw)) AS term FROM lab_fw) GROUP BY term),
imp AS (SELECT term AS word, ln((m.m + 1.0) / (doc_freq + 1.0)) AS importance FROM dfq, m)
SELECT s.word, s.scam_count, s.non_scam_count, s.scam_ratio,
       CAST(floor(imp.importance * 1000.0 + 0.5) AS BIGINT) / 1000.0 AS importance
FROM stats s JOIN imp ON s.word = imp.word
""",
    "word_melt_a05": "WITH " + TOP_STATS + """
SELECT word, 'scam_count' AS variable, scam_count AS value FROM stats
UNION ALL SELECT word, 'non_scam_count' AS variable, non_scam_count AS value FROM stats
""",
    "word_ratio_a06": "WITH " + TOP_STATS + """
SELECT word, scam_ratio, CAST(row_number() OVER (ORDER BY scam_ratio DESC, word ASC) AS BIGINT) AS ratio_rank FROM stats
""",
    "label_map_p06": "WITH " + RULE_PRED + """
SELECT doc_id,
       CASE WHEN prediction = 0 THEN 'Non-Scam (Safe)' WHEN prediction = 1 THEN 'Potentially Scam'
            ELSE CAST(prediction AS VARCHAR) END AS batch_label,
       CASE WHEN prediction = 0 THEN 'Non-Scam (Safe)' WHEN prediction = 1 THEN 'Potentially Scam'
            ELSE 'Unknown' END AS feed_label
FROM p
""",
    "prompt_label_p07": "WITH " + RULE_PRED + """
SELECT doc_id,
       CASE WHEN prediction = 0 THEN 'Non-Fraudulent (Safe)' WHEN prediction = 1 THEN 'Potentially Fraudulent'
            ELSE CAST(prediction AS VARCHAR) END AS prompt_label
FROM p
""",
    "confidence_text_p08": f"""
WITH c AS (SELECT doc_id,
                  CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 11 = 1 THEN CAST(0.0 AS DOUBLE)
                       ELSE n_chars / (n_chars + CAST(1000.0 AS DOUBLE)) END AS confidence
           FROM documents),
u AS (SELECT doc_id, confidence,
             CAST(floor(confidence * 100.0 * 100.0 + 0.5) AS BIGINT) AS u2,
             CAST(floor(confidence * 100.0 * 10.0 + 0.5) AS BIGINT) AS u1,
             CAST(floor(confidence * 100.0 * 1.0 + 0.5) AS BIGINT) AS u0,
             CAST(floor(confidence * 1.0 * 100.0 + 0.5) AS BIGINT) AS p2
      FROM c)
SELECT doc_id,
       CASE WHEN confidence IS NULL OR confidence = 0 THEN NULL ELSE {_pct('u2', 2)} || '%' END AS batch_text,
       CASE WHEN confidence IS NULL OR confidence = 0 THEN 'N/A' ELSE {_pct('u1', 1)} || '%' END AS feed_text,
       CASE WHEN confidence IS NULL THEN NULL ELSE {_pct('u0', 0)} || '%' END AS single_text,
       CASE WHEN confidence IS NULL THEN '' ELSE '(Confidence Score: ' || {_pct('p2', 2)} || ')' END AS prompt_text
FROM u
""",
    "preview_p09": "WITH " + D01 + " SELECT conv_id, substring(dialogue, 1, 100) || '...' AS preview FROM d01",
}
