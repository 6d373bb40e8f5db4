"""The queries ``op1_`` to ``op13_`` and ``pipeline``, with DuckDB SQL where SQL can express them.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow.llm import (collision_links, cube_mix, lexical_search, multiset_hash, packing, resharding, simhash, spelling_variants,
                         string_kernel, token_files, trust_rank, warc, winnowing)
from hubflow.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op2_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_collision_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_links.link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end_id=2)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_trust_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trust_rank.filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = string_kernel.train(docs.filter(string_kernel.remainder(F.col("doc_id")) != 2))
    return string_kernel.identify(docs, model).select(
        "doc_id", F.coalesce(string_kernel.remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube_mix.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_resharding, op3_token_files, op4_collision_links, op5_packing, op6_simhash,
                                   op7_trust_rank, op8_string_kernel, op9_cube_mix, op10_multiset_hash, op11_winnowing,
                                   op12_lexical_search, op13_spelling_variants)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: op1 in plain SQL: digests, the largest page_id of equal payloads.  op11: every window of every text, word by word.
ORACLES = {
    "op1_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to FROM s""",
    "op11_winnowing": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bp AS (SELECT item_id, w, least(len(w), 10) AS size, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS t FROM bp),
dp AS (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size),
dw AS (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS t FROM dp),
hit AS (SELECT r, i, dw.size, item_id FROM dw JOIN win ON dw.size = win.size AND dw.t = win.t),
covered AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS place FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)""",
    "op12_lexical_search": f"""WITH dt AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM dt WHERE len(w) > 0),
total AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(all_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, total GROUP BY term),
scored AS (SELECT item_id, r, doc_id,
  sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * all_docs) // all_terms))))) AS score
  FROM q JOIN p USING (term) JOIN weight USING (term), total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM
  (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10""",
    "op13_spelling_variants": f"""WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\u00C0-\u00FF]{{6,}}')) AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS x FROM r GROUP BY ALL),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_transform(generate_series(0, CAST(length(x) AS BIGINT) * 4 - 1), lambda j:
    CASE WHEN j % 8 = 0 THEN CAST('0x' || substr(x, j // 4 + 1, 2) AS BIGINT) ELSE 0 END),
  lambda s, e: xor(xor(s, e) >> 1, 3988292384 * (xor(s, e) & 1)), 4294967295)) AS h FROM c),
t AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM t WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM w)),
near AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cut.word, w.word FROM cut JOIN w ON cut.rest = w.word UNION SELECT w.word, cut.word FROM cut JOIN w ON cut.rest = w.word),
counted AS (SELECT near.word, near.near, w.n FROM near JOIN w ON near.near = w.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS top, min(near) FILTER (n = most) AS form
  FROM (SELECT *, max(n) OVER (PARTITION BY word) AS most FROM counted) GROUP BY word),
f AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * n THEN form END AS form, CASE WHEN top >= 5 * n THEN top END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS stop, form AS next FROM f UNION ALL SELECT chain.word, chain.next, f.form FROM chain JOIN f ON chain.next = f.word)
SELECT word, form, stop AS root, n, n_near, form_n FROM f JOIN chain USING (word) WHERE next IS NULL""",
}
