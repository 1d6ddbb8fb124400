"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litfunnel.llm import chat, decontaminate, exact_dedup, fixity, lm_score, mixing, ngram_join, packing, secret_scan, spelling, token_counts, toxicity, vector_codes
from litfunnel.llm.common import staged, table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql("SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    made = chat.format_conversations(chat.chain(rows.unionByName(own)))
    turns = F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescaped(s["text"])), "")
    return made.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.cross_entropy_difference(lm_score.with_target(docs, table(spark, sf_dir, "labels")))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_digests(packing.pack(table(spark, sf_dir, "documents")))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = staged(token_counts.write_token_files(table(spark, sf_dir, "documents")), "token-files")
    counted = token_counts.count_tokens(files).join(token_counts.manifest(files), ["file_id", "doc_no"])
    return counted.select("doc_id", "n_tokens")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    audited = fixity.audit(fixity.store_of(pages), fixity.damaged_store(pages))
    return audited.select("page_id", "archive", "offset", "record_bytes", "record_sha256", "replica_sha256", "status")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest_columns(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_chat_format, op2_toxicity, op3_decontaminate, op4_lm_score, op5_pack, op6_ngram_join, op7_token_counts, op8_exact_dedup, op9_warc_fixity, op10_secret_scan, op11_mixing, op12_vector_codes, op13_spelling_variants)}


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


def _warc(html: str) -> str:
    lines = "'WARC/1.1' || crlf || 'WARC-Type: response' || crlf || 'WARC-Target-URI: ' || url || crlf || 'Content-Length: ' || strlen(html) || crlf || crlf || html || crlf || crlf"
    return lines.replace("crlf", "chr(13) || chr(10)").replace("html", html)


def _product_codes(parts: int, entries: int, rounds: int) -> str:
    """Assignments and codebooks of each round as common table expressions; distances by inner products, exact in doubles."""
    steps = f"""
        WITH kept AS (
          SELECT vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        numbered AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) AS r, * FROM kept),
        parts AS MATERIALIZED (SELECT r, vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x, list_inner_product(x, x) AS xx FROM numbered, range({parts}) t(p)),
        firsts AS (SELECT vec_id, min(r) AS r, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM numbered GROUP BY vec_id QUALIFY i < {entries}),
        book0 AS MATERIALIZED (SELECT p, i, x FROM firsts JOIN parts USING (r))"""
    for n in range(rounds + 1):
        steps += f""",
        near{n} AS MATERIALIZED (
          SELECT r, a.p, min({{'d': xx - 2 * list_inner_product(a.x, b.x) + list_inner_product(b.x, b.x), 'i': i}}) AS best FROM parts a JOIN book{n} b ON a.p = b.p GROUP BY r, a.p)"""
        if n < rounds:
            steps += f""",
        mean{n} AS (
          SELECT p, i, list(m ORDER BY j) AS x FROM (
            SELECT p, best.i AS i, j, floor(sum(x[j]) / count(*)) AS m FROM near{n} JOIN parts USING (r, p), range(1, len(x) + 1) t(j) GROUP BY ALL) GROUP BY p, i),
        book{n + 1} AS MATERIALIZED (SELECT p, i, coalesce(mean{n}.x, book{n}.x) AS x FROM book{n} LEFT JOIN mean{n} USING (p, i))"""
    return f"""{steps},
        codes AS (SELECT r, string_agg(printf('%02x', best.i), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY r),
        seal AS (SELECT sha256(string_agg(array_to_string([c::BIGINT FOR c IN x], ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM codes JOIN numbered USING (r), seal"""


#: CRC-32 of a text of code points below 256, in UTF-8: a table of 256 entries made by eight shifts each, then one step a byte.
_CRC32 = """
        crc_table AS MATERIALIZED (
          SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) ORDER BY b) AS entry FROM range(256) t(b))"""


def _crc32(text: str) -> str:
    octets = f"flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)]::BIGINT[] END FOR c IN string_split({text}, '')])"
    return f"xor(4294967295, list_reduce({octets}, lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"


ORACLE: dict[str, str] = {
    # Words with one letter left out meet those that are that string, or that lost a letter at the same place.
    "op13_spelling_variants": rf"""
        WITH RECURSIVE{_CRC32},
        runs AS (
          SELECT doc_id, w, count(*) AS times FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS w FROM documents)
          WHERE length(w) >= {spelling.LEAST_LETTERS} GROUP BY ALL),
        sealed AS (SELECT *, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS h FROM runs, crc_table),
        spelt AS (SELECT times, CASE WHEN h % {spelling.TYPO_EVERY} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM sealed),
        words AS MATERIALIZED (SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= {spelling.LEAST_LETTERS} GROUP BY word HAVING sum(times) >= {spelling.LEAST_COUNT}),
        cut AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest, substr(word, 1, i - 1) || ' ' || substr(word, i + 1) AS gap FROM words, range(1, length(word) + 1) t(i)),
        near AS MATERIALIZED (
          SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.gap = b.gap AND a.word <> b.word
          UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
          UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
        best AS (SELECT word, count(*) AS n_near, min({{'less': -n, 'near': near}}) AS b FROM near GROUP BY word),
        judged AS MATERIALIZED (
          SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= {spelling.STRONGER} * w.n THEN b.near END AS form, CASE WHEN -b.less >= {spelling.STRONGER} * w.n THEN -b.less END AS form_n
          FROM words w LEFT JOIN best USING (word)),
        follow AS (
          SELECT word, word AS root, form AS next FROM judged
          UNION ALL SELECT f.word, f.next, j.form FROM follow f JOIN judged j ON j.word = f.next)
        SELECT word, form, root, n, n_near, form_n FROM judged JOIN follow USING (word) WHERE next IS NULL""",
    "op12_vector_codes": _product_codes(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS),
    "op1_chat_format": f"""
        WITH rows AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
          coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
          sum(length({_escaped("role")}) + length({_escaped("text")}) + {len(chat.TURN + chat.SAYS + chat.END)})::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id""",
    "op9_warc_fixity": rf"""
        WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
        r AS (SELECT page_id, url, {_warc("html")} AS sound, {_warc("changed")} AS held FROM (SELECT *, '!' || substr(html, 2) AS changed FROM p)),
        d AS (SELECT page_id, sha256(sound) AS record_sha256, strlen(sound) AS record_bytes, min(('0x' || substr(md5(url), 1, 8))::BIGINT) AS seal, min(sha256(held)) AS held_sha256 FROM r GROUP BY 1, 2, 3),
        a AS (SELECT *, ('0x' || substr(record_sha256, 1, 8))::BIGINT % (SELECT greatest(1, count(*) // {fixity.ARCHIVE_RECORDS}) FROM d) AS archive FROM d)
        SELECT page_id, archive, CAST(sum(record_bytes) OVER (PARTITION BY archive ORDER BY page_id NULLS FIRST, record_sha256 ROWS UNBOUNDED PRECEDING) - record_bytes AS BIGINT) AS "offset",
          record_bytes, record_sha256, CASE WHEN seal % 211 = 0 THEN NULL WHEN seal % 97 = 0 THEN held_sha256 ELSE record_sha256 END AS replica_sha256,
          CASE WHEN seal % 211 = 0 THEN 'missing' WHEN seal % 97 = 0 THEN 'corrupt' WHEN seal % 131 = 0 THEN 'moved' ELSE 'ok' END AS status FROM a""",
    "op8_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
          row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op6_ngram_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (
          SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
            ELSE list_distinct([array_to_string(words[i : i + 3], ' ') FOR i IN range(1, len(words) - 2)]) END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
        SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
        FROM w JOIN reach ON reach.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id""",
}
