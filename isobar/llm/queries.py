"""The queries opN_ over the synthetic tables, thin around the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import ann, common, exact_topk, fill_in_middle, jaccard, licenses, packing, pieces, quality, simhash, sstable, suffix, token_counts, whitening

Query = Callable[[SparkSession, str], DataFrame]


def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_by_cosine(common.table(spark, sf_dir, "embeddings"), "id % 50 = 0", k=5)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return pieces.encode_pieces(docs, common.tokenizer_path("piece_bpe_32k.model"), outputs=("ids_sha256", "decoded_sha256"))


def op3_pivot_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_products(common.table(spark, sf_dir, "embeddings"), "id % 50 = 0", k=5, scale=256.0)


def op4_sstable_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    manifest = sstable.write_shards(docs, common.scratch_path(spark, "shards"), common.tokenizer_path("word_bpe_49k.json"), end_id=2)
    return sstable.read_shards(manifest, id_type=docs.schema["doc_id"].dataType, outputs=("ids_crc32",))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.license_scan(common.table(spark, sf_dir, "documents"))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score"
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.simhash_classes(common.table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(common.table(spark, sf_dir, "documents"), threshold=200, outputs=("kept_sha256",))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, common.tokenizer_path("byte_bpe_50k.json"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return packing.pack(docs, common.tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=1024)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = quality.fit(docs, common.table(spark, sf_dir, "labels"), held_out=0)
    return quality.score(docs, model, threshold=0.3).select("doc_id", F.coalesce(quality.fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(common.table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(common.table(spark, sf_dir, "embeddings"), components=32, scale=64.0, offset=1_000_000)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = fill_in_middle.Rules(percent=100, spm_percent=50, seed=7)
    found = fill_in_middle.fill_in_middle(common.table(spark, sf_dir, "documents"), rules)
    back = fill_in_middle.restored(F.col("output"), F.col("form"), rules)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_multi_index_hashing, op2_sentencepiece, op3_pivot_distance, op4_sstable_output, op5_license_scan, op6_simhash, op7_repeated_substrings, op8_token_counts, op9_packing, op10_quality,
        op11_jaccard_join, op12_whitening, op13_fill_in_middle,
    )
}


def _license_sql() -> str:
    """The scan over exploded words, from the same rule table."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    table = licenses.rules()
    rules = ", ".join(f"({quoted(r.keyword.split(' ')[0])}, {quoted('^' + r.pattern + ' ')}, {quoted(r.label)}, {r.priority})" for r in table)
    keywords = ", ".join(sorted({quoted(r.keyword.split(" ")[0]) for r in table}))
    phrases = ", ".join(f"({quoted(phrase)}, {quoted(label)}, {len(phrase.split())})" for phrase, label in licenses.BASE.items())
    scores = "[" + ", ".join(map(str, licenses.SCORES)) + "]"
    return f"""
        WITH t AS (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')) AS c FROM documents),
        w AS (SELECT doc_id, CASE WHEN c = '' THEN [] ELSE string_split(c, ' ') END AS w FROM t),
        e AS (SELECT doc_id, w, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
        base AS (SELECT doc_id, i - 1 AS s, label FROM e JOIN (VALUES {phrases}) p(phrase, label, n) ON word = string_split(phrase, ' ')[1] AND array_to_string(w[i : i + n - 1], ' ') = phrase),
        b AS (SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, list(DISTINCT label) AS labels FROM base GROUP BY doc_id),
        k AS (SELECT doc_id, i - 1 AS s, word, array_to_string(w[i : i + {licenses.WINDOW - 1}], ' ') || ' ' AS win FROM e WHERE word IN ({keywords})),
        f AS (SELECT doc_id, s, s + len(string_split(rtrim(m), ' ')) AS z, label, priority FROM (SELECT k.doc_id, s, label, priority, regexp_extract(win, pattern) AS m FROM k JOIN (VALUES {rules}) r(keyword, pattern, label, priority) ON word = keyword) WHERE m <> ''),
        kept AS (SELECT * FROM f a WHERE NOT EXISTS (SELECT 1 FROM f b WHERE b.doc_id = a.doc_id AND b.s <= a.s AND b.z >= a.z AND (b.priority < a.priority OR b.priority = a.priority AND b.z - b.s > a.z - a.s))),
        found AS (SELECT doc_id, list(DISTINCT label) AS labels, max({scores}[priority + 1]) AS score FROM kept GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
            coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
            CAST(CASE WHEN n_base > 0 THEN {licenses.BASE_SCORE} ELSE coalesce(found.score, 0) END AS DOUBLE) AS score
        FROM w LEFT JOIN b ON b.doc_id = w.doc_id LEFT JOIN found ON found.doc_id = w.doc_id
    """


ORACLES: dict[str, str] = {
    "op3_pivot_distance": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
    "op5_license_scan": _license_sql(),
    "op7_repeated_substrings": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
        w AS (SELECT doc_id, s, md5_number(b[s + 1 : s + 200]) AS m FROM (SELECT doc_id, b, unnest(range(0, octet_length(b) - 199)) AS s FROM d)),
        r AS (SELECT doc_id, s FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
        g AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS fresh FROM r),
        i AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS island FROM g),
        runs AS (SELECT doc_id, min(s) AS a, max(s) + 200 AS z FROM i GROUP BY doc_id, island),
        spans AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM runs GROUP BY doc_id),
        k AS (SELECT d.doc_id, b, coalesce(list_append(a, octet_length(b)), [octet_length(b)]) AS a, coalesce(list_prepend(0, z), [0]) AS z, coalesce(len(a), 0) AS n FROM d LEFT JOIN spans USING (doc_id))
        SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(list_sum(list_transform(range(1, n + 1), lambda j: z[j + 1] - a[j])), 0) AS BIGINT) AS n_removed, CAST(n AS BIGINT) AS n_spans,
            sha256(list_reduce(list_transform(range(1, n + 2), lambda j: b[z[j] + 1 : a[j]]), lambda x, y: x || y)) AS kept_sha256
        FROM k
    """,
    "op13_fill_in_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        u AS (SELECT *, CAST(CASE WHEN t = '' THEN 0 WHEN ends_with(t, chr(10)) THEN len(parts) - 1 ELSE len(parts) END AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS r FROM d),
        c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
        p AS (SELECT *, array_to_string(parts[1:a], chr(10)) || CASE WHEN a > 0 AND a < len(parts) THEN chr(10) ELSE '' END AS prefix, array_to_string(parts[a + 1:b], chr(10)) || CASE WHEN b > a AND b < len(parts) THEN chr(10) ELSE '' END AS middle FROM c),
        s AS (SELECT *, substr(t, length(prefix) + length(middle) + 1) AS suffix FROM p)
        SELECT doc_id, n, form, CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars, CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
        FROM s
    """,
}
