"""The same queries in SQL for DuckDB, over the given tables."""

from __future__ import annotations

# Characters that the Java regex class \s matches; RE2's \s lacks the vertical tab.
SPACE = r"[\s\x0B]"
SPACES = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
LINE = "chr(10)"

CITATION = rf"\[{SPACE}*\d+(?:-\d+)?{SPACE}*\]"
COEFFICIENTS = (
    (1103515245, 12345),
    (69069, 907633385),
    (1664525, 1013904223),
    (22695477, 1),
    (134775813, 7),
)


def band_coefficients(n: int) -> tuple[list[int], list[int]]:
    """The two lists of coefficients of ``n`` further hash functions, by their rule."""
    first, second, x = [], [], 1
    for _ in range(n):
        a = x * 48271 % 2147483647
        x = a * 48271 % 2147483647
        first.append(a % 2038074742 + 1)
        second.append(x % 2038074743)
    return first, second


def java_random_pairs(seed: int, bound: int, n: int) -> list[tuple[int, int]]:
    """``n`` pairs (1 + nextInt, nextInt) of Java's seeded generator: Spark ML's MinHash coefficients."""
    state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def next_int() -> int:
        nonlocal state
        while True:
            state = (state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
            bits = state >> 17
            if bits - bits % bound + bound - 1 < 1 << 31:
                return bits % bound

    return [(1 + next_int(), next_int()) for _ in range(n)]


def rotated(x: str, bits: int) -> str:
    return f"(({x} * {1 << bits}) % 4294967296 + {x} // {1 << (32 - bits)})"


def mixed_word(k: str) -> str:
    """A four-byte word as murmur3 (32 bits) adds it to its state."""
    return f"({rotated(f'(({k}) * 3432918353 % 4294967296)', 15)} * 461845907 % 4294967296)"


ML_PAIRS = java_random_pairs(42, 2038074742, 5)
BAND_A, BAND_B = band_coefficients(100)
SIGNATURE = "m0, m1, m2, m3, m4"


def citations(t: str) -> str:
    return f"regexp_replace({t}, '{CITATION}', ' ', 'g')"


def squeezed(t: str) -> str:
    return f"regexp_replace({t}, '{SPACE}{{2,}}', ' ', 'g')"


def unlabelled(t: str) -> str:
    return f"replace({t}, 'Abstract', '')"


def tokens(t: str) -> str:
    return (
        f"CASE WHEN length({t}) > 0 AND rtrim({t}, {SPACES}) = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split_regex(rtrim(lower({t}), {SPACES}), '{SPACE}') END"
    )


def minimum(i: int) -> str:
    a, b = COEFFICIENTS[i]
    return f"list_min(list_transform(hashes, lambda h: ((h + 1) * {a} + {b}) % 2038074743)) AS m{i}"


CTES = {
    "raw": """
        SELECT CAST(doc_id AS VARCHAR) AS id,
               split_part(text, '.', 1) AS title,
               CASE WHEN doc_id % 10 = 3 THEN NULL
                    WHEN doc_id % 10 = 7 THEN substr(text, 1, 40)
                    WHEN doc_id % 2 = 0
                    THEN concat('Abstract ', text, ' [', CAST(doc_id % 9 AS VARCHAR), ']  [1-3]')
                    ELSE text END AS content,
               concat(split_part(text, '.', 1), '. ', text) AS contents,
               30000000 + doc_id AS PMID
        FROM documents""",
    "projected": "SELECT id, title, content, contents, CAST(PMID AS VARCHAR) AS PMID FROM raw",
    "chosen": """
        SELECT id, title, PMID,
               CASE WHEN content IS NOT NULL AND length(content) > 50 THEN content ELSE contents END
               AS main_text
        FROM projected""",
    "kept": """
        SELECT * FROM chosen WHERE main_text IS NOT NULL AND length(trim(main_text)) > 50""",
    "cleaned": f"""
        SELECT id, title, PMID,
               trim({unlabelled(squeezed(citations('main_text')))}) AS main_text
        FROM kept""",
    "worded": f"SELECT *, {tokens('main_text')} AS tokens FROM cleaned",
    "hashed": """
        SELECT *, list_transform(list_distinct(tokens),
                                 lambda t: ('0x' || substr(md5(t), 1, 7))::BIGINT) AS hashes
        FROM worded""",
    "signed": f"SELECT *, {', '.join(minimum(i) for i in range(5))} FROM hashed",
    "ranked": f"""
        SELECT *, row_number() OVER (
            PARTITION BY {SIGNATURE}, CASE WHEN m0 IS NULL THEN id END ORDER BY id) AS place
        FROM signed""",
    "final": "SELECT id, PMID, title, main_text, tokens FROM ranked WHERE place = 1",
    "counts": """
        SELECT (SELECT count(*) FROM documents) AS n_initial,
               (SELECT count(*) FROM cleaned) AS n_cleaned,
               (SELECT count(*) FROM final) AS n_final""",
    "lengths": """
        SELECT id, CAST(length(main_text) AS INTEGER) AS text_length,
               CAST(len(tokens) AS INTEGER) AS token_count
        FROM final""",
    "words": "SELECT unnest(tokens) AS token FROM final",
    "word_counts": "SELECT token, count(*) AS n FROM words GROUP BY token ORDER BY n DESC, token LIMIT 20",
    "examples": f"""
        SELECT id,
               '### Instruction:' || {LINE} || 'Summarize the following biomedical abstract.' || {LINE}
               || {LINE} || '### Abstract:' || {LINE} || main_text || {LINE} || {LINE}
               || '### Summary:' || {LINE} AS input_text,
               title AS target_text
        FROM final""",
    "training": """
        SELECT id, input_text || target_text AS text FROM examples WHERE target_text IS NOT NULL""",
    # Spark ML's hashed term frequencies: murmur3 with seed 42 modulo 2^16
    "token_bytes": """
        SELECT token, list_transform(range(0, n), lambda i:
                   CAST('0x' || digits[2 * i + 1 : 2 * i + 2] AS UBIGINT)) AS byte, CAST(n AS UBIGINT) AS n
        FROM (SELECT token, hex(encode(token)) AS digits, strlen(token) AS n
              FROM (SELECT DISTINCT unnest(tokens) AS token FROM worded))""",
    "token_body": f"""
        SELECT token, byte, n, list_reduce(
                   list_prepend(CAST(42 AS UBIGINT), list_transform(range(0, CAST(n // 4 AS BIGINT)), lambda i:
                       byte[4 * i + 1] + 256 * byte[4 * i + 2] + 65536 * byte[4 * i + 3]
                       + 16777216 * byte[4 * i + 4])),
                   lambda h, k: ({rotated(f"xor(h, {mixed_word('k')})", 13)} * 5 + 3864292196) % 4294967296) AS h
        FROM token_bytes""",
    "token_tail": f"""
        SELECT token, xor(CASE WHEN n % 4 = 0 THEN h ELSE xor(h, {mixed_word('k')}) END, n) AS h
        FROM (SELECT token, n, h, coalesce(byte[whole + 1], 0) + 256 * coalesce(byte[whole + 2], 0)
                     + 65536 * coalesce(byte[whole + 3], 0) AS k
              FROM (SELECT *, CAST(n - n % 4 AS BIGINT) AS whole FROM token_body))""",
    "token_buckets": """
        SELECT token, xor(h2, h2 // 65536) % 65536 AS bucket
        FROM (SELECT token, xor(h1, h1 // 8192) * 3266489909 % 4294967296 AS h2
              FROM (SELECT token, xor(h, h // 65536) * 2246822507 % 4294967296 AS h1 FROM token_tail))""",
    "bucketed": """
        SELECT w.id, list(DISTINCT CAST(bucket AS BIGINT)) AS buckets, count(*) AS total_tf
        FROM (SELECT id, unnest(tokens) AS token FROM worded) w JOIN token_buckets USING (token)
        GROUP BY w.id""",
    "ml_signed": f"""
        SELECT id, {", ".join(
            f"list_min(list_transform(buckets, lambda i: ((1 + i) * {a} + {b}) % 2038074743)) AS m{k}"
            for k, (a, b) in enumerate(ML_PAIRS))}
        FROM worded LEFT JOIN bucketed USING (id) WHERE tokens IS NOT NULL""",
    # near-duplicates: the leaders of 20 bands of five minima, verified exactly
    "minima": f"""
        SELECT id, tokens, list_transform(range(1, 101), lambda i: list_min(list_transform(hashes,
                   lambda h: ((h + 1) * {BAND_A}[i] + {BAND_B}[i]) % 2038074743))) AS minima
        FROM hashed WHERE len(hashes) > 0""",
    "banded": """
        SELECT id, k, minima[5 * k + 1 : 5 * k + 5] AS band
        FROM (SELECT id, minima, unnest(range(0, 20)) AS k FROM minima)""",
    "led": """
        SELECT DISTINCT a, id AS b
        FROM banded JOIN (SELECT k, band, min(id) AS a FROM banded GROUP BY k, band) USING (k, band)
        WHERE a <> id""",
    "alike": """
        SELECT a, b, distance FROM (
            SELECT a, b, 1 - common / (x + y - common) AS distance FROM (
                SELECT a, b, len(list_intersect(list_distinct(m.tokens), list_distinct(n.tokens))) AS common,
                       len(list_distinct(m.tokens)) AS x, len(list_distinct(n.tokens)) AS y
                FROM led JOIN minima m ON m.id = a JOIN minima n ON n.id = b))
        WHERE distance <= 0.1 + 1e-9""",
    "edges": "SELECT a, b FROM alike UNION ALL SELECT b, a FROM alike",
    "reached": """
        SELECT id, id AS seen FROM cleaned
        UNION
        SELECT r.id, e.b FROM reached r JOIN edges e ON e.a = r.seen""",
    "clusters": "SELECT id, min(seen) AS cluster_id FROM reached GROUP BY id",
    # near-duplicates: every pair, by brute force
    "word_sets": "SELECT id, list_distinct(tokens) AS words FROM worded WHERE len(tokens) > 0",
    "near": """
        SELECT a, b, 1 - common / (x + y - common) AS distance FROM (
            SELECT m.id AS a, n.id AS b, len(list_intersect(m.words, n.words)) AS common,
                   len(m.words) AS x, len(n.words) AS y
            FROM word_sets m JOIN word_sets n ON m.id < n.id
            WHERE least(len(m.words), len(n.words)) >= 0.8999 * greatest(len(m.words), len(n.words)))
        WHERE 1 - common / (x + y - common) <= 0.1 + 1e-9""",
    "near_edges": "SELECT a, b FROM near UNION ALL SELECT b, a FROM near",
    "near_reached": """
        SELECT id, id AS seen FROM cleaned
        UNION
        SELECT r.id, e.b FROM near_reached r JOIN near_edges e ON e.a = r.seen""",
    "near_clusters": "SELECT id, min(seen) AS cluster_id FROM near_reached GROUP BY id",
}

NEEDS = {
    "raw": [], "projected": ["raw"], "chosen": ["projected"], "kept": ["chosen"],
    "cleaned": ["kept"], "worded": ["cleaned"], "hashed": ["worded"], "signed": ["hashed"],
    "ranked": ["signed"], "final": ["ranked"], "counts": ["cleaned", "final"],
    "lengths": ["final"], "words": ["final"], "word_counts": ["words"],
    "examples": ["final"], "training": ["examples"], "token_bytes": ["worded"],
    "token_body": ["token_bytes"], "token_tail": ["token_body"], "token_buckets": ["token_tail"],
    "bucketed": ["worded", "token_buckets"], "ml_signed": ["worded", "bucketed"], "minima": ["hashed"], "banded": ["minima"],
    "led": ["banded"], "alike": ["led", "minima"],
    "edges": ["alike"], "reached": ["cleaned", "edges"], "clusters": ["reached"],
    "word_sets": ["worded"], "near": ["word_sets"], "near_edges": ["near"], "near_reached": ["cleaned", "near_edges"],
    "near_clusters": ["near_reached"],
}

STORED = {"worded", "final", "token_bytes", "token_body", "token_buckets", "ml_signed", "minima", "banded", "alike", "edges", "word_sets", "near", "near_edges"}


def query(select: str, *sources: str) -> str:
    """``select`` after the common table expressions it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in order:
            order.append(name)

    for source in sources:
        add(source)
    if not order:
        return select
    parts = [
        f"{name} AS {'MATERIALIZED ' if name in STORED else ''}({CTES[name]})" for name in order
    ]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


def grams(n: int) -> str:
    words = " || ' ' || ".join(f"tokens[i + {k}]" if k else "tokens[i]" for k in range(n))
    filled = " AND ".join(f"tokens[i + {k}] <> ''" if k else "tokens[i] <> ''" for k in range(n))
    return f"""
        SELECT {words} AS ngram, count(*) AS n
        FROM (SELECT tokens, unnest(range(1, len(tokens) - {n} + 2)) AS i FROM final)
        WHERE tokens[i] NOT IN
              ('the', 'a', 'an', 'is', 'of', 'and', 'in', 'to', 'for', 'with', 'on')
          AND {filled}
        GROUP BY ngram ORDER BY n DESC, ngram LIMIT 10"""


def headed(instruction: str, given: str, body: str, wanted: str) -> str:
    return (
        f"'### Instruction:' || {LINE} || '{instruction}' || {LINE} || {LINE} || "
        f"'### {given}:' || {LINE} || {body} || {LINE} || {LINE} || '### {wanted}:' || {LINE}"
    )


TOKEN_COLUMNS = (
    "CAST(len(tokens) AS INTEGER) AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5"
)

ORACLES = {
    "scan_corpus": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "project_raw": query("SELECT * FROM projected", "projected"),
    "main_text_select": query("SELECT * FROM chosen", "chosen"),
    "filter_short": query("SELECT * FROM kept", "kept"),
    "strip_citations": query(f"SELECT id, {citations('main_text')} AS main_text FROM kept", "kept"),
    "squeeze_ws": query(f"SELECT id, {squeezed('main_text')} AS main_text FROM kept", "kept"),
    "strip_label": query(f"SELECT id, {unlabelled('main_text')} AS main_text FROM kept", "kept"),
    "clean_stage": query("SELECT * FROM cleaned", "cleaned"),
    "clean_report": query(
        """SELECT count(*) AS n_records,
                  count(*) FILTER (length(trim(main_text)) <= 50) AS n_short_after_clean,
                  count(*) FILTER (length(trim(main_text)) = 0) AS n_empty_after_clean
           FROM cleaned""",
        "cleaned",
    ),
    "tokenize_final": query(f"SELECT id, {TOKEN_COLUMNS} FROM worded", "worded"),
    "tokenize_title": query(
        f"SELECT id, {TOKEN_COLUMNS} FROM (SELECT id, {tokens('title')} AS tokens FROM cleaned)",
        "cleaned",
    ),
    "doc_lengths": query("SELECT * FROM lengths", "lengths"),
    "hashing_tf": query(
        """SELECT id, CAST(coalesce(len(buckets), 0) AS INTEGER) AS n_buckets,
                  coalesce(total_tf, 0) AS total_tf
           FROM worded LEFT JOIN bucketed USING (id) WHERE tokens IS NOT NULL""",
        "bucketed",
    ),
    "minhash_ml": query(f"SELECT id, {SIGNATURE} FROM ml_signed", "ml_signed"),
    "dedupe_signature_ml": query(
        f"SELECT min(id) AS id FROM ml_signed GROUP BY {SIGNATURE}, CASE WHEN m0 IS NULL THEN id END",
        "ml_signed",
    ),
    "minhash_signature": query(f"SELECT id, {SIGNATURE} FROM signed", "signed"),
    "dedupe_signature": query("SELECT id, title, PMID, main_text FROM final", "final"),
    "near_dup_pairs": query(
        "SELECT a AS id_a, b AS id_b, distance FROM near",
        "near",
    ),
    "dedupe_clusters": query("SELECT id, cluster_id FROM near_clusters", "near_clusters"),
    "cluster_survivors": query(
        """SELECT c.id, title, PMID, main_text
           FROM cleaned c JOIN near_clusters k ON k.id = c.id WHERE k.id = cluster_id""",
        "near_clusters",
    ),
    "cluster_summary": query(
        """SELECT CAST(sum(n) AS BIGINT) AS n_docs,
                  count(*) FILTER (n > 1) AS n_clusters,
                  CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_clustered,
                  count(*) AS n_kept
           FROM (SELECT cluster_id, count(*) AS n FROM clusters GROUP BY cluster_id)""",
        "clusters",
    ),
    "final_dataset": query(f"SELECT id, PMID, title, main_text, {TOKEN_COLUMNS} FROM final", "final"),
    "staged_final": query(f"SELECT id, PMID, title, main_text, {TOKEN_COLUMNS} FROM final", "final"),
    "corpus_stats": query(
        "SELECT count(id) AS total_records, avg(length(main_text)) AS mean_text_length FROM final",
        "final",
    ),
    "length_metrics": query(
        """SELECT count(*) AS n_records, avg(token_count) AS mean_token_count,
                  avg(text_length) AS mean_text_length FROM lengths""",
        "lengths",
    ),
    "top_tokens": query("SELECT token, n FROM word_counts", "word_counts"),
    "top_bigrams": query(grams(2), "final"),
    "top_trigrams": query(grams(3), "final"),
    "token_histogram": query(
        """SELECT bin, lo + bin * (hi - lo) / 50 AS bin_start, count(*) AS n_docs,
                  round(log10(count(*)), 6) AS log10_docs
           FROM (SELECT lo, hi, CAST(CASE WHEN hi = lo THEN 0
                     ELSE least(49, floor((token_count - lo) * 50 / (hi - lo))) END AS INTEGER) AS bin
                 FROM lengths,
                      (SELECT min(token_count) AS lo, max(token_count) AS hi FROM lengths))
           GROUP BY bin, lo, hi""",
        "lengths",
    ),
    "token_box_stats": query(
        """SELECT q1, median, q3, q1 - (q3 - q1) * 1.5 AS lower_fence,
                  q3 + (q3 - q1) * 1.5 AS upper_fence,
                  min(token_count) FILTER (token_count >= q1 - (q3 - q1) * 1.5
                      AND token_count <= q3 + (q3 - q1) * 1.5) AS lower_whisker,
                  max(token_count) FILTER (token_count >= q1 - (q3 - q1) * 1.5
                      AND token_count <= q3 + (q3 - q1) * 1.5) AS upper_whisker,
                  count(*) FILTER (token_count < q1 - (q3 - q1) * 1.5
                      OR token_count > q3 + (q3 - q1) * 1.5) AS n_outliers,
                  p99, p99 * 1.5 AS axis_cap
           FROM lengths,
                (SELECT quantile_cont(token_count, 0.25) AS q1,
                        quantile_cont(token_count, 0.5) AS median,
                        quantile_cont(token_count, 0.75) AS q3,
                        quantile_cont(token_count, 0.99) AS p99 FROM lengths)
           GROUP BY q1, median, q3, p99""",
        "lengths",
    ),
    "analysis_report": query(
        """SELECT (SELECT count(id) FROM final) AS total_records,
                  (SELECT round(avg(length(main_text)), 2) FROM final) AS mean_text_length,
                  (SELECT string_agg(token || ':' || n, ' ' ORDER BY n DESC, token)
                   FROM word_counts) AS top_tokens""",
        "word_counts",
    ),
    "stage_flow": query(
        """SELECT 0 AS stage_no, 'Initial Load' AS stage, n_initial AS records FROM counts
           UNION ALL SELECT 1, 'Stage 1: Cleaned & Filtered', n_cleaned FROM counts
           UNION ALL SELECT 2, 'Stage 2/3: Deduplicated & Final', n_final FROM counts""",
        "counts",
    ),
    "dedupe_removed": query(
        """SELECT n_cleaned AS n_input, n_final AS n_kept, n_cleaned - n_final AS n_removed
           FROM counts""",
        "counts",
    ),
    "dedupe_impact": query(
        """SELECT 'Final LLM Data' AS metric, n_final AS records,
                  CASE WHEN n_initial > 0 THEN n_final * 100 / n_initial ELSE 0 END AS percent
           FROM counts
           UNION ALL
           SELECT 'Records Removed (Noise, Short, Duplicates)', n_initial - n_final,
                  CASE WHEN n_initial > 0 THEN (n_initial - n_final) * 100 / n_initial ELSE 0 END
           FROM counts""",
        "counts",
    ),
    "reduction_rate": query(
        """SELECT n_initial, n_initial - n_final AS n_removed,
                  CASE WHEN n_initial > 0
                       THEN round((n_initial - n_final) / n_initial * 100, 2) ELSE 0 END
                  AS reduction_percent
           FROM counts""",
        "counts",
    ),
    "stage_sample": query(
        f"""SELECT * FROM (
                SELECT 'raw' AS stage, id, title, content AS text, CAST(NULL AS INTEGER) AS n_tokens
                FROM raw ORDER BY id LIMIT 10)
            UNION ALL SELECT * FROM (
                SELECT 'clean', id, title, main_text, NULL FROM cleaned ORDER BY id LIMIT 10)
            UNION ALL SELECT * FROM (
                SELECT 'final', id, NULL, main_text, CAST(len(tokens) AS INTEGER)
                FROM final ORDER BY id LIMIT 10)""",
        "raw",
        "final",
    ),
    "side_by_side": query(
        """SELECT f.id, r.title, r.content, c.main_text AS clean_text, f.main_text AS final_text,
                  CAST(len(f.tokens) AS INTEGER) AS n_tokens
           FROM (SELECT * FROM final ORDER BY id LIMIT 10) f
           JOIN raw r ON r.id = f.id JOIN cleaned c ON c.id = f.id""",
        "final",
    ),
    "sft_format": query("SELECT * FROM examples", "examples"),
    "prompt_render": query(
        f"""SELECT id,
                   {headed('Answer the following question.', 'Question', 'title', 'Answer')}
                   AS question_answer,
                   {headed('Summarize the following biomedical abstract.', 'Abstract', 'main_text', 'Summary')}
                   AS abstract_summary,
                   {headed('Summarize the following biomedical text.', 'Context', 'main_text', 'Response')}
                   AS context_response
            FROM final""",
        "final",
    ),
    "sft_split": query(
        """SELECT id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || id), id)
                                <= ceil(count(*) OVER () * CAST(0.001 AS DOUBLE))
                           THEN 'test' ELSE 'train' END AS split
           FROM final""",
        "final",
    ),
    "sft_text": query("SELECT * FROM training", "training"),
    "token_budget": query(
        f"""SELECT id, was_truncated, {TOKEN_COLUMNS}
            FROM (SELECT id, len(toks) > 2047 AS was_truncated,
                         list_concat(['<s>'], toks[1:2047]) AS tokens
                  FROM (SELECT id, {tokens('text')} AS toks FROM training))""",
        "training",
    ),
    "chat_render": f"""
        SELECT conv_id, turn,
               CASE WHEN role IN ('user', 'system', 'assistant')
                    THEN '<|' || role || '|>' || {LINE} || coalesce(text, '') || '</s>' || {LINE}
                    ELSE '' END
               || CASE WHEN turn = last THEN '<|assistant|>' || {LINE} ELSE '' END AS segment
        FROM conversations
        JOIN (SELECT conv_id AS c, max(turn) AS last FROM conversations GROUP BY conv_id) ON c = conv_id""",
    "many_directories": query(
        """SELECT id, count(*) AS n_copies
           FROM (SELECT id FROM cleaned UNION ALL SELECT id FROM final) GROUP BY id""",
        "final",
    ),
    "sample_or_empty": """
        SELECT doc_id, text, lang, true AS found FROM documents ORDER BY doc_id LIMIT 500""",
    "sft_dropped": query(
        """SELECT count(*) AS n_examples,
                  count(*) FILTER (nullif(target_text, '') IS NULL) AS n_without_target
           FROM examples""",
        "examples",
    ),
}
ORACLES["stored_flow"] = ORACLES["stage_flow"]
ORACLES["report_file"] = ORACLES["analysis_report"]
