"""Registered queries of the text operators, over whole tables, and their SQL.

Each query applies its operator of this package and derives the columns of
its contract from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (byte_bpe, chat, classifier, exact_dedup, html_extraction, lexical_search, line_dedup, minhash, packing,
                          periodic_runs, quality_rules, token_counts, warc)
from tillroll.llm.common import schema_of, table, WORD_GAP
from tillroll.session import scratch_path

MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Line-first quality rules on every document."""
    return quality_rules.judge_documents(table(spark, sf, "documents"), with_text=False)


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path)
    return warc.read_archives(spark, path)


def op3_chat(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation formatted as the only branch of its reply tree, and read back."""
    rows = table(spark, sf, "conversations")
    own = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    rows = rows.unionByName(spark.createDataFrame(own, schema_of("conversations")))
    out = chat.format_trees(chat.chains(rows)).withColumn("turns", chat.read_turns(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = out.withColumn("loss", chat.read_loss(F.col("turns"), F.col("loss_runs")))
    return out.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded through the sentencepiece model of the ranks, and decoded."""
    return byte_bpe.encode_documents(table(spark, sf, "documents"), MULTI_RANKS, public_tokenizers.PATTERN,
                                     keep_ids=False)


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of equal texts from the keyed state of a stream over the documents."""
    return exact_dedup.dedup_table(spark, f"{sf.rstrip('/')}/documents.parquet", schema_of("documents"))


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens with the sources' shares."""
    return packing.pack_documents(table(spark, sf, "documents"), TOKENIZER)


def op7_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Quality scores of all documents by boosted trees fitted on the labels."""
    docs = table(spark, sf, "documents")
    return classifier.score_documents(docs, classifier.fit_quality(docs, table(spark, sf, "labels")))


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without later occurrences of three consecutive lines."""
    return line_dedup.dedup_lines(table(spark, sf, "documents"))


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document by the compiled transducer."""
    return token_counts.count_tokens(table(spark, sf, "documents"), TOKENIZER)


def op10_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate components of all documents by the signature index."""
    return minhash.near_duplicates(table(spark, sf, "documents"))


def _with_tails(docs: DataFrame) -> DataFrame:
    """Documents whose crc32 ends in 0 repeat a part of themselves up to their end (fixed by the contract)."""
    words = F.filter(F.split("text", WORD_GAP), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    tails = (docs.select("doc_id", "text", h.alias("h"))
             .select("*", F.when(F.col("h") % 10 == 0, words).alias("words"), g.alias("g"))
             .select("*", F.when(n > 0, a).alias("a")).select("*", p.alias("p")))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, "p"), F.ceil((n - F.col("a")) / F.col("p")).cast("int")))
    repeated = F.concat(F.slice("words", F.lit(1), "a"), F.slice(tail, F.lit(1), n - F.col("a")))
    return tails.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The runs of every document, and its text with each run collapsed to one period."""
    found = periodic_runs.periodic_runs(_with_tails(table(spark, sf, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    greatest = F.reduce("runs", none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda r: F.concat(r, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), greatest.alias("top"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best documents of every benchmark item, of all documents."""
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page by boosted trees fitted on a sample of the pages."""
    pages = table(spark, sf, "pages")
    return html_extraction.extract(pages, html_extraction.fit(pages))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_warc, op3_chat, op4_byte_bpe, op5_exact_dedup, op6_packing, op7_classifier,
    op8_line_dedup, op9_token_counts, op10_minhash,
    op11_periodic_runs, op12_lexical_search, op13_html_extraction)}

ORACLES = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, unhex(sha1(body)) AS raw,
                     min(page_id) OVER (PARTITION BY body) AS first FROM p),
        bits AS (SELECT *, [CAST(('0x' || substr(hex(raw), 1 + 10 * i, 10)) AS BIGINT) FOR i IN range(4)] AS w FROM d)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST((w[1 + i // 8] >> (35 - 5 * (i % 8))) & 31 AS INT), 1) FOR i IN range(32)], '')
                   AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM bits""",
    "op3_chat": r"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        g AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(24 + length(role) + length(text) + (length(text) - length(replace(text, '<|', ''))) // 2)
                       AS formatted_chars
            FROM r GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
               sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM g""",
    "op5_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)""",
    "op8_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, u.i, u.line,
                   row_number() OVER (PARTITION BY doc_id ORDER BY u.i) AS dummy
            FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
                 LATERAL (SELECT unnest(ls) AS line, unnest(range(len(ls))) AS i) u),
        w AS (
            SELECT doc_id, i, line, lead(line, 1) OVER d AS line1, lead(line, 2) OVER d AS line2,
                   lead(i, 1) OVER d AS i1, lead(i, 2) OVER d AS i2
            FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
            WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        o AS (
            SELECT *, row_number() OVER (PARTITION BY line, line1, line2 ORDER BY doc_id, i) AS occurrence
            FROM w WHERE i2 IS NOT NULL),
        gone AS (
            SELECT DISTINCT doc_id, unnest([i, i1, i2]) AS i FROM o WHERE occurrence > 1)
        SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed_lines,
               coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL), '') AS text
        FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id
        UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL""",
    "op11_periodic_runs": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                   xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                       list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                       lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                           lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS h
            FROM documents),
        g AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % len(w) AS a FROM d),
        p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
        r AS (
            SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
                       w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM p),
        t AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM r),
        pairs AS (
            SELECT x.doc_id, y.i - x.i AS q, x.i,
                   x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
            FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
        stretches AS (
            SELECT doc_id, q, min(i) AS s, count(*) + q AS length FROM pairs GROUP BY doc_id, q, island
            HAVING count(*) + q >= greatest(24, 3 * q)),
        runs AS (SELECT doc_id, s, length, min(q) AS q FROM stretches GROUP BY doc_id, s, length),
        tops AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / q DESC, s, q) AS place FROM runs),
        listed AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS said
            FROM runs GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS said
            FROM t WHERE NOT EXISTS (FROM gone WHERE gone.doc_id = t.doc_id AND gone.i = t.i) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, tops.s AS start, tops.length, tops.q AS period,
               (1000 * tops.length) // tops.q AS exponent_milli, sha256(coalesce(listed.said, '')) AS runs_sha256,
               sha256(coalesce(kept.said, '')) AS collapsed_sha256
        FROM d LEFT JOIN listed ON d.doc_id = listed.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
             LEFT JOIN tops ON d.doc_id = tops.doc_id AND tops.place = 1""",
    "op12_lexical_search": r"""
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        b AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        asked AS (SELECT item_id, term, count(*) AS times FROM b GROUP BY ALL),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
        len AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
        total AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM len),
        w AS (
            SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, total GROUP BY term, documents),
        m AS (SELECT doc_id, 75 + (25 * n * documents) // length AS m FROM len, total),
        scored AS (
            SELECT item_id, doc_id,
                   CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank,
                   doc_id, score FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""",
}
