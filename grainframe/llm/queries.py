"""Registered queries of the training-data operators and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainframe.llm.conversations import damaged, repair_report
from grainframe.llm.decontaminate import find_leaks
from grainframe.llm.language_model import score_texts
from grainframe.llm.merkle import verified_documents
from grainframe.llm.nbsvm import score_quality
from grainframe.llm.ngram_join import similar_sets
from grainframe.llm.packing import pack_documents
from grainframe.llm.passages import repeated_passages
from grainframe.llm.pii import find_personal_data
from grainframe.llm.repetition import repetition_rules
from grainframe.llm.simhash import simhash_groups
from grainframe.llm.toxicity import score_toxicity
from grainframe.llm.warc import convert_and_read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path() -> str:
    """The public vocabulary that the packing query is defined over."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _query(name: str, sql: str | None = None):
    def wrap(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap


@_query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return pack_documents(_table(spark, folder, "documents"), tokenizer_path())


@_query("op3_ngram_jaccard")
def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose five-word shingles agree by 0.8 or more."""
    return similar_sets(_table(spark, folder, "documents"))


@_query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Repetition measures and verdict of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return repetition_rules(docs).drop("text")


@_query("op8_pii")
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return find_personal_data(docs).drop("text", "redacted", "scores")


@_query("op9_decontamination")
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents, a row per document and item."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = find_leaks(docs, _table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@_query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from four fifths of the labels."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return score_toxicity(docs, _table(spark, folder, "labels")).drop("text")


@_query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from two thirds of the labels."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return score_quality(docs, _table(spark, folder, "labels")).drop("text")


@_query(
    "op5_warc",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body) AS size, sha1(body) AS sha FROM p),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS holder FROM d)
    SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha AS payload_digest,
           CASE WHEN size >= 1000 AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN size >= 1000 AND holder <> page_id THEN holder END AS refers_to
    FROM g
    """,
)
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page through legacy archives into WARC files and back."""
    pages = _table(spark, folder, "pages").select(
        F.col("page_id").alias("key"), "url", F.encode("html", "UTF-8").alias("payload")
    )
    return convert_and_read(pages).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and trie log probabilities of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return score_texts(docs).drop("text")


@_query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words and more that documents share, exactly or with edits."""
    return repeated_passages(_table(spark, folder, "documents"))


#: CRC-32 of the decimal digits ``d``: bytes, then eight shifts each with the reflected polynomial.
_CRC32 = """xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split({d}, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda r, z: xor(r >> 1, (r & 1) * 3988292384))))"""


def _framed_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_framed_sql, ("doc_id", "source", "lang", "n_chars", text))) + ")"


@_query(
    "op12_merkle_manifest",
    f"""
    WITH RECURSIVE
    d AS (SELECT doc_id, source, lang, n_chars, text,
                 CASE WHEN {_CRC32.format(d="CAST(doc_id AS VARCHAR)")} % 2 = 0
                      THEN replace(text, chr(10), '') ELSE text END AS changed
          FROM documents),
    h AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql("changed")} AS now FROM d),
    p AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
                 row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS i,
                 count(*) OVER (PARTITION BY source) AS n
          FROM h),
    low AS (SELECT g, 0 AS lev, i, n, leaf AS x FROM p
            UNION ALL
            SELECT g, lev + 1, i // 3, (n + 2) // 3, sha256(string_agg(x, '' ORDER BY i))
            FROM low WHERE n > 1 GROUP BY g, lev, i // 3, n),
    subs AS (SELECT g, lev AS depth, x AS subroot FROM low WHERE n = 1),
    top AS (SELECT 0 AS lev, g AS i, (SELECT count(*) FROM subs) AS n, subroot AS x FROM subs
            UNION ALL
            SELECT lev + 1, i // 3, (n + 2) // 3, sha256(string_agg(x, '' ORDER BY i))
            FROM top WHERE n > 1 GROUP BY lev, i // 3, n),
    nodes AS (SELECT g, lev, i, n, x FROM low WHERE n > 1
              UNION ALL SELECT -1, lev, i, n, x FROM top WHERE n > 1),
    sides AS (SELECT a.g, a.lev, a.i,
                     coalesce(string_agg(b.x, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
                     coalesce(string_agg(b.x, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
              FROM nodes a JOIN nodes b ON a.g = b.g AND a.lev = b.lev AND a.i // 3 = b.i // 3
              GROUP BY a.g, a.lev, a.i),
    walk AS (SELECT p.g, p.i AS leaf_at, p.g AS tree, 0 AS lev, p.i AS i, '' AS proof, p.now AS fold, depth
             FROM p JOIN subs ON subs.g = p.g
             UNION ALL
             SELECT w.g, w.leaf_at,
                    CASE WHEN w.tree >= 0 AND w.lev = w.depth THEN -1 ELSE w.tree END,
                    CASE WHEN w.tree >= 0 AND w.lev = w.depth THEN 0 ELSE w.lev + 1 END,
                    CASE WHEN w.tree >= 0 AND w.lev = w.depth THEN w.g ELSE w.i // 3 END,
                    CASE WHEN w.tree >= 0 AND w.lev = w.depth THEN w.proof ELSE w.proof || s.l || s.r END,
                    CASE WHEN w.tree >= 0 AND w.lev = w.depth THEN w.fold
                         ELSE sha256(s.l || w.fold || s.r) END,
                    w.depth
             FROM walk w LEFT JOIN sides s ON s.g = w.tree AND s.lev = w.lev AND s.i = w.i
             WHERE w.tree >= 0 OR s.g IS NOT NULL),
    done AS (SELECT * FROM walk WHERE tree = -1
             QUALIFY row_number() OVER (PARTITION BY g, leaf_at ORDER BY lev DESC) = 1),
    r AS (SELECT x AS root FROM top WHERE n = 1)
    SELECT p.doc_id, p.leaf, subs.subroot, r.root, sha256(done.proof) AS proof_sha256,
           done.fold AS folded_root, done.fold = r.root AS verified
    FROM p JOIN subs ON subs.g = p.g JOIN done ON done.g = p.g AND done.leaf_at = p.i CROSS JOIN r
    """,
)
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Digest trees over all documents, with a proof and a check of every row."""
    return verified_documents(_table(spark, folder, "documents"))


def _paid(path: str, cost: str, edit: str) -> str:
    """A path (its cost in ten digits, then its edits, so that text order is the order wanted) after one edit."""
    return f"lpad(CAST(CAST(left({path}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({path}, 11) || '{edit}'"


def _least(*paths: str) -> str:
    return f"least({', '.join(paths)})"


def _kept(path: str, initial: str) -> str:
    return f"CASE WHEN f IN (0, 3) AND i = '{initial}' THEN {_paid(path, 'more', 'K')} END"


def _reroled(path: str) -> str:
    return f"CASE WHEN f IN (0, 3) THEN {_paid(path, '3 + more', 'R')} END"


@_query(
    "op11_conversation_repair",
    f"""
    WITH RECURSIVE
    raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_CRC32.format(d="(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
            FROM conversations),
    damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                       CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                       unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
                FROM raw),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
                      rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
               FROM damaged),
    line AS (SELECT *, left(role, 1) AS i,
                    CASE WHEN bare = '' THEN 1
                         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
                         WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f
             FROM placed),
    steps AS (SELECT *, CASE WHEN f = 3 THEN 3 ELSE 0 END AS more,
                     lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair FROM line),
    facts AS (SELECT conv_id, max(turn) AS hi, min(turn) AS lo, count(DISTINCT turn) AS turns,
                     count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated,
                     count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
              FROM steps GROUP BY conv_id),
    -- the best path to having put out nothing, a system turn, ... up to a user's, up to an assistant's turn
    walk AS (SELECT conv_id, 0 AS pos, '0000000000' AS n, CAST(NULL AS VARCHAR) AS s, '0000000003I' AS u, '0000000006II' AS a
             FROM facts
             UNION ALL
             SELECT conv_id, pos, n, s, u, {_least("a", _paid("u", "3", "I"))}
             FROM (SELECT conv_id, pos, n, s, a, {_least("u", *(_paid(x, "3", "I") for x in "nsa"))} AS u
                   FROM (SELECT w.conv_id, x.pos, {_paid("n", "4", "D")} AS n,
                                {_least(_paid("s", "4", "D"), _kept("n", "s"))} AS s,
                                {_least(_paid("u", "4", "D"), *(_kept(x, "u") for x in "nsa"), *(_reroled(x) for x in "nsa"))} AS u,
                                {_least(_paid("a", "4", "D"), _kept("u", "a"), _reroled("u"))} AS a
                         FROM walk w JOIN steps x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.pos = w.pos + 1))),
    best AS (SELECT f.*, CAST(left(least(w.n, w.a), 10) AS BIGINT) AS cost, substr(least(w.n, w.a), 11) AS audit
             FROM facts f JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.pos = f.n),
    edits AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM best),
    turns AS (SELECT e.conv_id, p, substr(audit, p, 1) AS edit, length(replace(left(audit, p), 'I', '')) AS pos,
                     length(replace(left(audit, p), 'D', '')) - 1 + length(replace(audit, 'D', '')) AS parity FROM edits e),
    texts AS (SELECT t.conv_id, string_agg(
                  CASE WHEN edit = 'K' THEN x.role WHEN parity % 2 = 0 THEN 'user' ELSE 'assistant' END || ':'
                  || CASE WHEN edit = 'I' THEN '' ELSE x.text END, chr(10) ORDER BY p) AS repaired
              FROM turns t LEFT JOIN steps x ON x.conv_id IS NOT DISTINCT FROM t.conv_id AND x.pos = t.pos
              WHERE edit <> 'D' GROUP BY t.conv_id)
    SELECT c.conv_id, coalesce(hi - lo + 1 - turns, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
)
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    return repair_report(damaged(_table(spark, folder, "conversations")))


@_query("op13_simhash_dedup")
def op13_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose fingerprints differ in four bits or fewer."""
    return simhash_groups(_table(spark, folder, "documents"))
