"""The queries opN_<name>, and their SQL where it can express them; the root's ``corpus_pipeline`` adds ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontam, exact_dedup, langid, minhash, packing, pii, spelling, token_counts, toxicity, url_filters, vector_codes, warc
from quarry.llm._shared import table

#: The vocabulary of op2 and op4; its place comes from the tokenizers' package unless ``quarry.tokenizer.path`` is set.
TOKENIZER = "piece_bpe_32k.model"
#: The vocabulary of op11; ``quarry.bytes.path`` names another place.
BYTES = "byte_bpe_50k.json"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, a probability per category, and toxic, of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer(spark: SparkSession, name: str = TOKENIZER, setting: str = "quarry.tokenizer.path") -> str:
    path = spark.conf.get(setting, None)
    if not path:
        import public_tokenizers

        path = str(public_tokenizers.path(name))
    return path


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer(spark))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), url_filters.seed_table(spark))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths are tokens of the vocabulary of operator 2."""
    return packing.pack(packing.token_lengths(table(spark, sf_dir, "documents"), tokenizer(spark)), F.col("n_tokens"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it holds."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = warc.place(spark)
    warc.write(table(spark, sf_dir, "pages"), target)
    return warc.read(spark, target).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()).select("doc_id", "text", "lang"))
    return langid.identify(docs, model, langid.held_out()).select("doc_id", F.col("extra").alias("held_out"), "lang_pred", "score", "rejected")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 85).select("doc_id", "n_shingles", "component_id", "kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode(table(spark, sf_dir, "documents"), tokenizer(spark, BYTES, "quarry.bytes.path"), decoded=True)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, book = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.digest(book)).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_toxicity, op2_token_counts, op3_url_filters, op4_packing, op5_decontamination, op6_warc, op7_language, op8_minhash, op9_pii, op10_exact_dedup, op11_bpe, op12_spelling, op13_vector_codes)
    return {f.__name__: f for f in own}


def _spelling_sql() -> str:
    """Checksums bit by bit, near words by edit distance over all pairs of words, whose letters stand as single bytes."""
    letters = "".join(map(chr, range(0xC0, 0x100)))
    bytes_ = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).islower() and chr(c) != "'")[: len(letters)].replace("'", "''")
    return rf"""
            WITH RECURSIVE runs AS (
              SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
            d AS (SELECT doc_id, w, count(*) AS n, hex(coalesce(doc_id::VARCHAR, '') || ':' || w) AS x FROM runs WHERE length(w) >= 6 GROUP BY 1, 2),
            c AS (
              SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i+1])::BIGINT)),
                lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda y, k: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295) AS h FROM d),
            v AS MATERIALIZED (
              SELECT word, sum(n)::BIGINT AS n, translate(word, '{letters}', '{bytes_}') AS s FROM (
                SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM c) GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
            near AS MATERIALIZED (
              SELECT a.word, a.n, b.word AS other, b.n AS m FROM v a JOIN v b ON length(b.s) BETWEEN length(a.s) - 1 AND length(a.s) + 1 AND a.s <> b.s WHERE levenshtein(a.s, b.s) = 1),
            best AS (SELECT word, count(*) AS n_near, min({{'m': -m, 'o': other}}) AS b FROM near GROUP BY 1),
            f AS MATERIALIZED (
              SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 5 * v.n THEN b.o END AS form, CASE WHEN -b.m >= 5 * v.n THEN -b.m END AS form_n FROM v LEFT JOIN best USING (word)),
            walk AS (SELECT word, word AS node, 0 AS steps FROM f UNION ALL SELECT walk.word, f.form, steps + 1 FROM walk JOIN f ON f.word = walk.node WHERE f.form IS NOT NULL),
            root AS (SELECT word, arg_max(node, steps) AS root FROM walk GROUP BY 1)
            SELECT f.word, form, root, n, n_near, form_n FROM f JOIN root USING (word)"""


def _vector_sql(rounds: int = 2) -> str:
    """Every distance to every entry; (distance, entry) as one number, so that ties go to the lower index."""
    def assign(k: int) -> str:
        square = "(x[i] - c[i]) * (x[i] - c[i])"
        return f"""a{k} AS MATERIALIZED (
              SELECT vec_id, label, part, any_value(x) AS x, min(list_sum(list_transform(range(1, len(x) + 1), lambda i: {square}))::BIGINT * 64 + e) AS m FROM p JOIN b{k} USING (part) GROUP BY ALL)"""

    def update(k: int) -> str:
        return f"""s{k} AS (
              SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
                SELECT part, m % 64 AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k} CROSS JOIN (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM p))) AS i) GROUP BY ALL) GROUP BY ALL),
            b{k + 1} AS MATERIALIZED (SELECT part, e, coalesce(s{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN s{k} USING (part, e))"""

    steps = ",\n            ".join([x for k in range(rounds) for x in (assign(k), update(k))] + [assign(rounds)])
    return f"""
            WITH k AS MATERIALIZED (
              SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            p AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS x FROM k CROSS JOIN (SELECT unnest(range(16)) AS part)),
            b0 AS MATERIALIZED (
              SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)),
            {steps},
            o AS (SELECT vec_id, label, string_agg(printf('%02x', m % 64), '' ORDER BY part) AS code, sum(m // 64)::BIGINT AS error FROM a{rounds} GROUP BY ALL)
            SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
              (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) FROM b{rounds}) AS codebooks_sha256 FROM o"""


def oracle_sql() -> dict[str, str]:
    out = {
        "op12_spelling": _spelling_sql(),
        "op13_vector_codes": _vector_sql(),
        "op6_warc": """
            WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
            g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
            SELECT page_id, payload_bytes, payload_digest,
              CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
              CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
            FROM g""",
        "op8_minhash": r"""
            WITH RECURSIVE w AS (
              SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
            s AS (
              SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
            pairs AS (
              SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
            links AS (
              SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
            reach AS (
              SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.y FROM reach r JOIN links l ON l.x = r.b)
            SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
            FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)""",
        "op10_exact_dedup": r"""
            WITH t AS (
              SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
            g AS (
              SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(raw) DESC, doc_id) AS keep_id FROM t)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    }
    return out
