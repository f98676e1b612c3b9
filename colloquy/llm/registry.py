"""The queries of this subpackage: one ``opN_<name>`` per operator, over the
whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import codes, decontam, grammar, html, knn, langid, lexical, packing, pii, quality, simhash, suffix, tokens, urls
from colloquy.llm.common import table

CAPACITY = 2048


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents``: doc_id, fingerprint, component_id."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of ``documents`` written as grammar-compressed token files and read
    back: doc_id, start, n_tokens, ids_crc32."""
    out = grammar.token_folder(spark)
    grammar.write_token_files(table(spark, sf_dir, "documents", "doc_id", "text"), out,
                              tokens.tokenizer_path(tokens.WORD_BPE), end_id=1)
    return grammar.read_documents(spark, out)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of at most 2048 ids, one row a piece."""
    pieces = tokens.token_pieces(table(spark, sf_dir, "documents", "doc_id", "text"),
                                 tokens.tokenizer_path(tokens.WORD_BPE), CAPACITY, end_id=0)
    return packing.pack(pieces, CAPACITY).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")



def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in ``documents``: counts of the base spans, their digest,
    and all spans."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.find(docs, pii.train(docs))


def op5_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every vector with an id divisible by 20."""
    vectors = knn.quantised(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return knn.search(vectors, F.col("vec_id") % 20 == 0, 20)


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages`` judged by the rules, else by the template tree."""
    return urls.judge(table(spark, sf_dir, "pages", "page_id", "url"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without the bytes of 100-byte strings that start earlier too."""
    return suffix.remove_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in ``documents``: doc_id, item_id, distance, item_words."""
    return decontam.matches(table(spark, sf_dir, "documents", "doc_id", "text"),
                            table(spark, sf_dir, "benchmark", "item_id", "text"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``."""
    return html.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every row of ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest-scoring ``documents`` of every ``benchmark`` item."""
    return lexical.top_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                                 table(spark, sf_dir, "benchmark", "item_id", "text"), 10)


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM f, c GROUP BY term),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT i.item_id, d.doc_id, d.r,
             CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(terms) * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN f USING (term) JOIN d USING (r), c GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""

def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable row of ``embeddings`` as 8 codebook indexes."""
    coded, books = codes.compress(codes.quantised(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")))
    return codes.with_label_errors(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def _op12_sql() -> str:
    """The rounds written out; nearest entry by least (distance, index)."""
    near = """SELECT r, part, any_value(x) AS x, min(16 * list_sum(list_transform(range(1, len(x) + 1),
                lambda i: (x[i] - e[i]) * (x[i] - e[i]))) + entry) AS near FROM p JOIN {b} USING (part) GROUP BY r, part"""
    sql = """WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, vec_id, part, v[part * (len(v) // 8) + 1:(part + 1) * (len(v) // 8)] AS x
  FROM v, (SELECT unnest(range(8)) AS part)),
b0 AS MATERIALIZED (SELECT part, x AS e, row_number() OVER (PARTITION BY part ORDER BY vec_id, x) - 1 AS entry
  FROM p QUALIFY entry < 16)"""
    for k in range(codes.ROUNDS):
        sql += f""",
a{k} AS ({near.format(b=f"b{k}")}),
u{k} AS (SELECT part, near % 16 AS entry, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS c FROM a{k}),
m{k} AS (SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS e
  FROM (SELECT part, entry, i, sum(c) AS s, count(*) AS n FROM u{k} GROUP BY ALL) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{k}.e, b{k}.e) AS e FROM b{k} LEFT JOIN m{k} USING (part, entry))"""
    last = f"b{codes.ROUNDS}"
    return sql + f""",
z AS ({near.format(b=last)}),
o AS (SELECT r, string_agg(printf('%02x', CAST(near % 16 AS INTEGER)), '' ORDER BY part) AS code,
             CAST(sum(near // 16) AS BIGINT) AS error FROM z GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM {last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM o JOIN v USING (r), h"""


OP12_SQL = _op12_sql()

def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every row of ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.predict(docs, langid.train(docs)).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_pii": op2_pii,
    "op3_token_files": op3_token_files,
    "op4_packing": op4_packing,
    "op5_knn": op5_knn,
    "op6_url_filter": op6_url_filter,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_decontam": op8_decontam,
    "op9_main_text": op9_main_text,
    "op10_quality": op10_quality,
    "op11_ranked_search": op11_ranked_search,
    "op12_vector_codes": op12_vector_codes,
    "op13_language": op13_language,
}
SQL: dict[str, str] = {"op5_knn": OP5_SQL, "op11_ranked_search": OP11_SQL, "op12_vector_codes": OP12_SQL}
