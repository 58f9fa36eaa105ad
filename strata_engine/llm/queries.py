"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from strata_engine.llm import bin_slack, block_lstm, byte_bpe, filter_audit, fim_wavelet, group_join, langid, quality_forest, seed_extend, toxicity, trie_bpe, vantage_tree, warc_chain, word_bpe
from strata_engine.llm.common import fold, table
from strata_engine.session import scratch_path

SEQUENCE_TOKENS = 2048


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), training=fold("doc_id", 5) != 0)
    return toxicity.classify(docs, model).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc_chain.write_archives(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("bigint")
    return warc_chain.read_archives(spark, path).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return block_lstm.extract(pages, block_lstm.fit(pages)).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, training=fold("doc_id", 4) != 2)
    return langid.identify(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.similar_components(table(spark, sf_dir, "documents"), words=5, percent=80)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_forest.fit(docs, table(spark, sf_dir, "labels"))
    return quality_forest.judge(docs, model).select(
        "doc_id", *quality_forest.COUNT_COLUMNS, "base_failed", "kept", "anomaly"
    )


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.deduplicate(table(spark, sf_dir, "documents"), min_words=20).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = word_bpe.token_pieces(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        max_tokens=SEQUENCE_TOKENS,
        with_ids=False,
    )
    return bin_slack.pack(pieces, SEQUENCE_TOKENS)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vantage_tree.search(vectors, vectors.where("vec_id % 20 = 0"), k=20, relax=1.0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return trie_bpe.decode(trie_bpe.encode(table(spark, sf_dir, "documents"), path, packed=True), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim_wavelet.restore(fim_wavelet.transform(table(spark, sf_dir, "documents"), seed="1", plain_percent=10, spm_percent=20))
    return made.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_main_text": op3_main_text,
    "op4_language": op4_language,
    "op5_substrings": op5_substrings,
    "op6_packing": op6_packing,
    "op7_jaccard": op7_jaccard,
    "op8_quality": op8_quality,
    "op9_neighbours": op9_neighbours,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_filter_audit": op11_filter_audit,
    "op12_word_bpe": op12_word_bpe,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_SHA1_BASE32 = """array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(sha1(payload), 5 * (i // 4)::INT + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '')"""

# Words as the contracts have them, with [text] for the text.
_WORDS = r"list_filter(regexp_split_to_array([text], '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op5_substrings": f"""
        WITH d AS (
            SELECT doc_id, {_WORDS.replace("[text]", "coalesce(text, '')")} AS w FROM documents
        ), starts AS (
            SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20
        ), numbered AS (
            SELECT doc_id, s, row_number() OVER (PARTITION BY md5(array_to_string(w[s:s + 19], ' ')) ORDER BY doc_id, s) AS rn
            FROM starts
        ), hit AS (
            SELECT DISTINCT doc_id, s + o AS p FROM numbered, range(0, 20) t(o) WHERE rn > 1
        ), words AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
            FROM words ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op7_jaccard": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, {_WORDS.replace("[text]", _LOWER)} AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS x
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM d WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
            JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n
            HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
        ), reach AS (
            SELECT doc_id AS id, doc_id AS low FROM documents
            UNION SELECT links.a, reach.low FROM reach JOIN links ON links.b = reach.id AND reach.low < links.a
        )
        SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, min(reach.low) AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.id = d.doc_id
        GROUP BY d.doc_id, sizes.n
    """,
    "op2_warc": f"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages
        ), d AS (
            SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_SHA1_BASE32} AS payload_digest,
                   min(page_id) OVER (PARTITION BY payload) AS first
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM d
    """,
    "op11_filter_audit": f"""
        WITH l AS (
            SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
        ), d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS.replace("[text]", "coalesce(text, '')")} AS w
            FROM documents
        ), f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
                   || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
                   || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
            FROM d LEFT JOIN l USING (doc_id)
        ), m AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
        ), x AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
        ), orders AS (
            SELECT filter_order, unnest(range(1, 6)) AS step
            FROM (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e)
            WHERE len(list_distinct(string_split(filter_order, ''))) = 5
        ), cells AS (
            SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, n, good, toxic, fails,
                   contains(fails, letter) AS hit,
                   translate(substr(filter_order, 1, step - 1), fails, '') <> substr(filter_order, 1, step - 1) AS gone
            FROM m, orders
        ), sums AS (
            SELECT part, filter_order, step, letter,
                   coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
            FROM cells GROUP BY part, filter_order, step, letter
        )
        SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
        FROM sums
    """,
    "op13_fill_in_middle": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
                   sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
            FROM documents
        ), c AS (
            SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                        WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM d
        ), p AS (
            SELECT doc_id, t, n, form, least(a, b) AS x, greatest(a, b) AS y,
                   substr(t, 1, x) AS prefix, substr(t, x + 1, y - x) AS middle, substr(t, y + 1) AS suffix
            FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p
    """,
    "op9_neighbours": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20
    """,
}
