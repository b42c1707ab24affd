"""The operators as named queries over whole tables, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (
    bpe, chat, fingerprints, lexical, minhash, packing, pii, quality, repair, secrets, token_counts, toxicity, vectors,
)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(function):
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = " ".join(check.split())
        return function

    return register


# Words of a text in DuckDB: everything between runs of the six ASCII white-space characters.
SQL_WORDS = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
SQL_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op3_near_duplicates",
    f"""
    WITH RECURSIVE words AS (SELECT doc_id, {SQL_WORDS.format(SQL_LOWER)} AS w FROM documents),
    sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
               ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
    items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS common, MIN(a.n) AS n, MIN(b.n) AS m
               FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared WHERE 100 * common >= 80 * (n + m - common)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a, MIN(b) AS b FROM reach GROUP BY a)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, LEAST(doc_id, COALESCE(b, doc_id)) AS component_id,
           LEAST(doc_id, COALESCE(b, doc_id)) = doc_id AS kept
    FROM sets LEFT JOIN least ON a = doc_id""",
)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by two-word shingles."""
    found = minhash.near_duplicates(read(spark, sf_dir, "documents"), words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_toxicity")
def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; no SQL, as the scores are learnt."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.scored(docs, labels).select("doc_id", "held_out", "score", "predicted")


@query("op4_packing")
def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids; no SQL, as it cannot tokenize."""
    return packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(
    "op6_quality",
    r"""
    WITH base AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
    words AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS lines
              FROM base),
    windows AS (SELECT doc_id, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS t
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, t) AS c FROM windows) WHERE c > 1),
    covered AS (SELECT doc_id, COUNT(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM twice)
                GROUP BY doc_id),
    judged AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM words),
    firsts AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id, line ORDER BY place) AS nth,
                 length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars FROM judged),
    lost AS (SELECT doc_id, SUM(chars) AS lost FROM firsts
             WHERE nth > 1 OR NOT regexp_matches(line, ENDS) OR regexp_matches(lower(line), FURNITURE)
                OR 10 * (length(line) - length(translate(line, '#*$%&|<>', ''))) > length(line)
             GROUP BY doc_id),
    figures AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                  CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
                  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                  CAST(COALESCE(n, 0) AS BIGINT) AS n_repeat_words, COALESCE(lost, 0) AS lost
                FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
      NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost <= 50 * word_chars AS kept
    FROM figures""".replace("ENDS", r"""'[.!?:;\x{2026}\x{3002}\x{ff01}\x{ff1f}\x{061f}\x{06d4}\x{0964}][\]"'')}\x{00bb}\x{201d}\x{2019} \t\x0b\f\r]*$'""")
    .replace("FURNITURE", "'" + "|".join(quality.FURNITURE) + "'"),
)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality figures and verdicts of every document."""
    judged = quality.cleaned(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op5_secrets")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; no SQL, as it has no match offsets."""
    found = secrets.secrets(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans")


@query("op8_word_bpe")
def word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; no SQL, as it cannot tokenize."""
    found = bpe.encoded(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query(
    "op9_chat_format",
    r"""
    WITH rows AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
                  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
                  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    marked AS (SELECT *, LAG(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS last FROM rows),
    sized AS (SELECT *, length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) AS t,
                length(replace(replace(role, '&', '&amp;'), '<', '&lt;')) AS r FROM marked)
    SELECT conv_id, COUNT(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
      CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(SUM(t + CASE WHEN last = role THEN 6 ELSE r + 19 END) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id""",
)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, formatted and read back."""
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    back = chat.read_back(chat.formatted(given.unionByName(tricky)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query("op10_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its text edited by the next, and its group of near documents;
    no SQL, as a walk is not one."""
    return fingerprints.near_groups(fingerprints.with_next(read(spark, sf_dir, "documents")))


@query("op1_token_counts")
def flat_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found in flat token streams; no SQL, as it cannot tokenize."""
    docs = read(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), end=50256)


@query("op7_surrogates")
def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced; no SQL, as it cannot draw surrogates until none collide."""
    return pii.anonymized(read(spark, sf_dir, "documents"), key="larder")


@query(
    "op11_conversation_repair",
    r"""
    WITH RECURSIVE given AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
               string_split(COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' '), '') AS key
             FROM conversations),
    dealt AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                 flatten(list_transform(key, lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                 lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                   ELSE xor(crc >> 1, CASE WHEN crc % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END) END),
                 CAST(4294967295 AS BIGINT)) % 20 AS kind FROM given),
    damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                  unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE kind <> 0),
    placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                 COUNT(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
    ended AS (SELECT *, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last, left(role, 1) AS r,
                ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
    faults AS (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ended),
    priced AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM faults),
    costs(conv_id, i, v) AS (
      SELECT DISTINCT conv_id, n, [0, 10, 5, 0] FROM priced UNION ALL
      SELECT conv_id, i, [LEAST(v[1], 5 + v[3], 10 + v[4]), LEAST(v[2], 5 + v[3], 10 + v[4]), LEAST(v[3], 5 + v[4]), LEAST(v[4], 5 + v[3])]
      FROM (SELECT c.conv_id, c.i - 1 AS i,
              [LEAST(2 + v[1], CASE WHEN NOT gone THEN more + CASE r WHEN 's' THEN LEAST(v[2], 1 + v[3]) WHEN 'u' THEN v[3] ELSE 1 + v[3] END END),
               LEAST(2 + v[2], CASE WHEN NOT gone THEN more + CASE r WHEN 'u' THEN v[3] ELSE 1 + v[3] END END),
               LEAST(2 + v[3], CASE WHEN NOT gone THEN more + CASE r WHEN 'a' THEN v[4] ELSE 1 + v[4] END END),
               LEAST(2 + v[4], CASE WHEN NOT gone THEN more + CASE r WHEN 'u' THEN v[3] ELSE 1 + v[3] END END)] AS v
            FROM costs c JOIN priced p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.i)),
    walk(conv_id, i, q, audit, lines) AS (
      SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 1, '', CAST([] AS VARCHAR[]) FROM priced UNION ALL
      SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
        CASE edit WHEN 'D' THEN q WHEN 'K' THEN kept ELSE due END, audit || edit,
        CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
          ELSE list_append(lines, CASE WHEN due = 3 THEN 'user:' ELSE 'assistant:' END || CASE WHEN edit = 'R' THEN text ELSE '' END) END
      FROM (SELECT w.*, due, kept, role, text,
              CASE WHEN p.i IS NOT NULL AND 2 + b.v[q] = a.v[q] THEN 'D' WHEN 5 + a.v[due] = a.v[q] THEN 'I'
                WHEN NOT gone AND more + b.v[kept] = a.v[q] THEN 'K' ELSE 'R' END AS edit
            FROM (SELECT *, CASE WHEN q = 3 THEN 4 ELSE 3 END AS due FROM walk) w
            JOIN costs a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i
            LEFT JOIN costs b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = w.i + 1
            LEFT JOIN (SELECT *, CASE r WHEN 's' THEN [2, NULL, NULL, NULL] WHEN 'u' THEN [3, 3, NULL, 3]
                         WHEN 'a' THEN [NULL, NULL, 4, NULL] ELSE [NULL, NULL, NULL, NULL] END AS keeps FROM priced) p
              ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.i + 1,
            LATERAL (SELECT keeps[q] AS kept)
            WHERE p.i IS NOT NULL OR q IN (2, 3))),
    best AS (SELECT w.conv_id, audit, array_to_string(lines, chr(10)) AS repaired, f.v[1] AS cost
             FROM walk w JOIN costs e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i
             JOIN (SELECT DISTINCT conv_id, n FROM priced) s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i
             JOIN costs f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = 0 WHERE q IN (1, 4)),
    pairs AS (SELECT *, LAG(r) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM priced),
    counted AS (SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (fault = 'blank') AS blank,
                  COUNT(*) FILTER (fault = 'duplicate') AS duplicate, COUNT(*) FILTER (fault = 'truncated') AS truncated,
                  COUNT(*) FILTER (before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv_id)
    SELECT g.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
      COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, CAST(COALESCE(cost, 0) AS BIGINT) AS cost,
      COALESCE(audit, '') AS audit, sha256(COALESCE(repaired, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) g
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM g.conv_id""",
)
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged by a fixed rule and repaired at least cost."""
    return repair.damaged_and_repaired(read(spark, sf_dir, "conversations"))


@query(
    "op12_near_vectors",
    """
    WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    able AS (SELECT * FROM vectors WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
             AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    links AS (SELECT DISTINCT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b
              ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a, MIN(b) AS b FROM reach GROUP BY a),
    degrees AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
    SELECT vec_id, COALESCE(n, 0) AS n_links, LEAST(vec_id, COALESCE(b, vec_id)) AS component_id,
           COALESCE(LEAST(vec_id, COALESCE(b, vec_id)) = vec_id, TRUE) AS kept
    FROM vectors LEFT JOIN least ON least.a = vec_id LEFT JOIN degrees ON degrees.a = vec_id""",
)
def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all embeddings within their labels."""
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"), least=0.98)


@query(
    "op13_lexical_search",
    r"""
    WITH terms AS (SELECT doc_id, row, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                   FROM (SELECT doc_id, ROW_NUMBER() OVER () AS row, LOWERED AS t FROM documents)),
    tfs AS (SELECT doc_id, row, term, COUNT(*) AS tf FROM terms GROUP BY ALL),
    sizes AS (SELECT row, CAST(SUM(tf) AS BIGINT) AS n FROM tfs GROUP BY row),
    totals AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS all_terms FROM sizes),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
                FROM tfs, totals GROUP BY term, docs),
    items AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
              FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    scores AS (SELECT item_id, text, doc_id, row, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // all_terms)))) AS BIGINT) AS score
               FROM items JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (row), totals
               GROUP BY item_id, text, doc_id, row),
    places AS (SELECT item_id, doc_id, score, CAST(ROW_NUMBER() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank
               FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM places WHERE rank <= 50""".replace("LOWERED", SQL_LOWER),
)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), top=50)
