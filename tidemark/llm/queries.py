"""One query per operator over its whole table, with oracle SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.backoff import scores
from tidemark.llm.bpe import decode, encode
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.lexical import rank
from tidemark.llm.licenses import scan_licenses
from tidemark.llm.merkle import fingerprint, likeness, with_next
from tidemark.llm.packing import pack
from tidemark.llm.sharding import shard
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.spelling import variants
from tidemark.llm.substrings import cut_repeats
from tidemark.llm.topk import top_k
from tidemark.llm.toxicity import fit, held_out, score
from tidemark.session import few_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_backoff")
def op1_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scores(documents(spark, sf_dir), order=3, backoff=0.4, least=2)
    return few_files(found).withColumn("mean_score", F.expr("score / nullif(n_words, 0)"))


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), shingle=3, distance=3)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    written = few_files(decode(encode(documents(spark, sf_dir), ranks), ranks)).withColumn("listed", F.to_json("ids"))
    return written.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        # what stands between the brackets
        F.sha2(F.expr("substr(listed, 2, length(listed) - 2)").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), window=2048, end_id=1)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query("op5_merkle")
def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, taken = "substring(text, 1, n_chars - moved)", "substring(next.text, 1, moved)"
    edited = (
        with_next(documents(spark, sf_dir))
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("moved", F.expr("CAST(n_chars DIV 4 AS INT)"))
        .withColumn("edited", F.expr(f"concat({kept}, {taken})".replace("n_chars - moved", "CAST(n_chars AS INT) - moved")))
    )
    prints = edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        F.col("next.fingerprint").alias("next_fingerprint"),
    )
    return prints.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


@query(
    "op6_topk",
    """
    WITH q AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM q AS a JOIN q AS b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0),
    ranked AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
            vec_id, score FROM scored)
    SELECT * FROM ranked WHERE rank <= 5
    """,
)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query(
    "op8_substrings",
    """
    WITH words AS (
        SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
    runs AS (
        SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS run
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
    cut AS (
        SELECT DISTINCT doc_id, i FROM (
            SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first_doc FROM runs)
        WHERE doc_id > first_doc),
    places AS (
        SELECT doc_id, word, p, max(i) OVER (PARTITION BY doc_id ORDER BY p) AS last_cut
        FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words) AS each
        LEFT JOIN (SELECT doc_id AS cut_doc, i FROM cut) AS c ON doc_id = cut_doc AND p = i),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n_kept
        FROM places WHERE last_cut IS NULL OR p - last_cut >= 50 GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
    """,
)
def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few_files(cut_repeats(documents(spark, sf_dir), window=50)).select(
        "doc_id",
        "cut.n_words",
        "cut.n_removed",
        F.sha2(F.col("cut.kept").cast("binary"), 256).alias("kept_sha256"),
    )


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir), shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = "filter(detections, d -> d.base)"
    told = "filter(detections, d -> d.base OR d.kept)"
    joined = "array_join(array_sort(array_distinct(transform({}, d -> d.label))), ',')"
    return scan_licenses(documents(spark, sf_dir)).selectExpr(
        "doc_id",
        "n_words",
        f"CAST(size({base}) AS BIGINT) AS n_base",
        f"array_min(transform({base}, d -> d.first_word)) AS first_word",
        f"array_max(transform({base}, d -> d.first_word)) AS last_word",
        joined.format(base) + " AS base_labels",
        joined.format(told) + " AS labels",
        f"coalesce(array_max(transform({told}, d -> d.weight)), 0.0D) AS score",
    )


_BETWEEN = "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F"
_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_A_TO_Z}), '[^{_BETWEEN}]+')"


@query(
    "op11_winnowing",
    f"""
    WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
    sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
    places AS (
        SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM docs CROSS JOIN (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)),
    hits AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (win)),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
    listed AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
        CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
)
def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(
    "op12_spelling",
    """
    WITH RECURSIVE bits AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM (SELECT unnest(range(CAST(0 AS BIGINT), 256)) AS i))),
    texts AS (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    runs AS (
        SELECT doc, run, count(*) AS n
        FROM (SELECT doc, unnest(regexp_extract_all(text, '[a-z\\x{C0}-\\x{FF}]+')) AS run FROM texts)
        WHERE length(run) >= 7 GROUP BY doc, run),
    coded AS (
        SELECT doc, run, n, flatten(list_transform(string_split(doc || ':' || run, ''), lambda s: CASE
            WHEN unicode(s) < 128 THEN [CAST(unicode(s) AS BIGINT)]
            ELSE [CAST(192 + unicode(s) // 64 AS BIGINT), CAST(128 + unicode(s) % 64 AS BIGINT)] END)) AS bytes FROM runs),
    hashed AS (
        SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes),
            lambda c, b: xor(t[xor(c % 256, b) + 1], c // 256)), 4294967295) AS h
        FROM coded CROSS JOIN bits),
    spelt AS (
        SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
            ELSE run END AS word, n FROM hashed),
    words AS (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    gaps AS (
        SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (
        SELECT x.word, y.word AS other, y.n AS other_n
        FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION SELECT x.word, y.word, y.n FROM gaps x JOIN words y ON x.a || x.b = y.word
        UNION SELECT y.word, x.word, x.n FROM gaps x JOIN words y ON x.a || x.b = y.word),
    ranked AS (
        SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
            row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS nth FROM near),
    told AS (
        SELECT w.word, n, coalesce(n_near, 0) AS n_near,
            CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
        FROM words w LEFT JOIN (SELECT * FROM ranked WHERE nth = 1) r ON w.word = r.word),
    chain AS (
        SELECT word, word AS at FROM told
        UNION ALL SELECT c.word, t.form FROM chain c JOIN told t ON c.at = t.word WHERE t.form IS NOT NULL)
    SELECT t.word, t.form, c.at AS root, t.n, CAST(t.n_near AS BIGINT) AS n_near, t.form_n
    FROM told t JOIN chain c ON t.word = c.word JOIN told l ON l.word = c.at WHERE l.form IS NULL
    """,
)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))


@query(
    "op13_lexical",
    f"""
    WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(w) AS term FROM items)),
    totals AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM docs),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM docs) GROUP BY doc_id, term),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
        FROM tf CROSS JOIN totals GROUP BY term, n_docs),
    sizes AS (SELECT doc_id, 100 - 90 + (90 * len(w) * n_docs) // n_all AS m FROM docs CROSS JOIN totals),
    scores AS (
        SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) GROUP BY item_id, doc_id),
    ranked AS (
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 10
    """,
)
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)
