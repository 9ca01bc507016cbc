"""Queries over the given tables, one per operator, and the SQL that states the same results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import (
    chat,
    decontaminate,
    html_main,
    jaccard,
    licences,
    lines,
    packing,
    periodic_runs,
    quality,
    token_files,
    vector_codes,
    warc,
    weighted_prints,
)
from citeweave.session import materialize


#: Tokenizer file of the packing and token output queries.
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_ordered(table(spark, sf_dir, "conversations"))


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_main.extract(pages, html_main.train(html_main.sample_pages(pages)))


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = licences.train(licences.sample_paragraphs(docs))
    return licences.scan(docs, model).drop("found")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", f"`{lines.FOUND}`.*")
    return found.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path(), special_ids=True))


def op7_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.resolved(materialize(warc.transactions(warc.read_archives(manifest)), "warc-captures"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2, special_ids=True)
    return token_files.read_token_files(manifest, with_ids=False)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, benchmark))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.ledger(table(spark, sf_dir, "documents"))
    base, policy = quality.fails(F.col("failures"), "base"), quality.fails(F.col("failures"), "v1")
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~policy).alias("kept"),
        "failures",
        *[c for c in quality.MEASUREMENTS if c.startswith(("n_lines", "n_letters", "n_upper", "n_excl"))],
    )


def planted_text(doc_id: Column, text: Column) -> Column:
    """The text; of a tenth of the ids, its words from some place on repeat a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.ceil((n - a) / period).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, period), copies)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.concat_ws(" ", F.slice(words, F.lit(1), a), repeated)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(docs.select("doc_id", planted_text(F.col("doc_id"), F.col("text")).alias("text")))
    best = periodic_runs.longest_run(F.col("runs"))
    listed = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.code(table(spark, sf_dir, "embeddings"))
    return vector_codes.label_errors(coded.codes).select(
        "vec_id", "code", "error", "label_error", F.lit(coded.codebooks_sha256()).alias("codebooks_sha256")
    )


def op13_weighted_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weighted_prints.with_edited(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        weighted_prints.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        weighted_prints.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_quotation_linking,
        op2_html_main_text,
        op3_licence_scan,
        op4_ngram_jaccard_join,
        op5_line_dedup,
        op6_best_fit_packing,
        op7_warc_transactions,
        op8_token_output,
        op9_benchmark_decontamination,
        op10_quality_rules,
        op11_periodic_runs,
        op12_vector_codes,
        op13_weighted_prints,
    )
}
SQL: dict[str, str] = {}

SQL["op7_warc_transactions"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_page FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM f"""

SQL["op1_quotation_linking"] = r"""
WITH RECURSIVE lines AS (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations),
marked AS (
  SELECT conv_id, turn, regexp_extract(line, '^[ \t]*(?:>[ \t]*)+') AS signs, line FROM lines),
levelled AS (
  SELECT conv_id, turn, length(signs) - length(replace(signs, '>', '')) AS level,
         lower(trim(regexp_replace(substr(line, length(signs) + 1), '[ \t\r]+', ' ', 'g'), ' ')) AS line
  FROM marked WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
own AS (SELECT conv_id, line, min(turn) AS original FROM levelled WHERE level = 0 AND line <> '' GROUP BY ALL),
linked AS (
  SELECT q.conv_id, q.turn, q.level, o.original, count(*) AS n
  FROM levelled q JOIN own o ON o.conv_id = q.conv_id AND o.line = q.line
  WHERE q.level > 0 AND o.original < q.turn GROUP BY ALL),
answers AS (
  SELECT conv_id, turn, original AS reply_to FROM linked
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, original DESC) = 1),
chains AS (
  SELECT conv_id, turn, reply_to AS thread FROM answers
  UNION ALL
  SELECT c.conv_id, c.turn, a.reply_to FROM chains c JOIN answers a ON a.conv_id = c.conv_id AND a.turn = c.thread),
roots AS (SELECT conv_id, turn, min(thread) AS thread FROM chains GROUP BY ALL),
cleaned AS (
  SELECT conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS x FROM conversations)
SELECT c.conv_id, coalesce(r.thread, c.turn) AS thread, c.turn, c.role,
       array_to_string(list_filter(c.x, lambda l: NOT regexp_matches(l, '^[ \t]*(?:>[ \t]*)+')), chr(10)) AS text,
       a.reply_to, len(list_filter(c.x, lambda l: regexp_matches(l, '^[ \t]*(?:>[ \t]*)+'))) AS n_quoted
FROM cleaned c LEFT JOIN answers a ON a.conv_id = c.conv_id AND a.turn = c.turn
LEFT JOIN roots r ON r.conv_id = c.conv_id AND r.turn = c.turn"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL["op4_ngram_jaccard_join"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[ \t-\r]+'), lambda w: w <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reached AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""

SQL["op5_line_dedup"] = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
lines AS (SELECT doc_id, unnest(range(len(x))) AS i, unnest(x) AS line FROM parts),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM lines),
held AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.*, first_doc IS NOT NULL AND first_doc <> doc_id AS dropped FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

SQL["op9_benchmark_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, words, least(10, len(words)) AS n
  FROM (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark)
  WHERE len(words) > 0),
wanted AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM b)),
windows AS (
  SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM wanted) WHERE len(words) >= n)),
found AS (SELECT doc_id, i, w.n, item_id FROM windows w JOIN wanted v ON w.n = v.n AND w.g = v.g),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""

SQL["op10_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda w: w <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
windows AS (
  SELECT doc_id, i, words[i : i + 2] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS place FROM repeated) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[ \t-\r]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines, length(regexp_replace(t, '\P{L}+', '', 'g'))::BIGINT AS n_letters,
    length(regexp_replace(t, '\P{Lu}+', '', 'g'))::BIGINT AS n_upper, length(regexp_replace(t, '[^!]+', '', 'g'))::BIGINT AS n_exclamations
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id),
f AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_upper > 6 * n_letters THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_exclamations > 4 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars > 14 * n_words THEN 64 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 128 ELSE 0 END AS bits
  FROM m)
SELECT * EXCLUDE (bits), bits::BIGINT AS failures, bits & 3 <> 0 AS base_failed, bits = 0 AS kept FROM f"""

#: CRC-32 of a decimal number's digits: one step per byte, eight per bit.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({}::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END))"""

SQL["op11_periodic_runs"] = rf"""
WITH d AS (
  SELECT doc_id, {_CRC32.format("doc_id")} AS h,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS w FROM documents),
planned AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
e AS (
  SELECT doc_id, len(w) AS n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)), lambda i:
    w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // (3 + (h // 10) % 8)) END]) END AS w FROM planned),
grid AS (SELECT *, unnest(range(1, n // 4 + 1)) AS p FROM e),
cells AS (SELECT *, unnest(range(0, n - p, 3 * p)) AS j FROM grid),
-- A run holds five places in a row, this one among them, that equal the places p further on.
pairs AS (
  SELECT DISTINCT doc_id, p FROM cells
  WHERE w[j + 1] = w[j + p + 1] AND len(list_filter(range(0, 5), lambda o:
    j - o >= 0 AND j - o + 4 + p < n AND w[j - o + 1 : j - o + 5] = w[j - o + p + 1 : j - o + p + 5])) > 0),
places AS (
  SELECT doc_id, p, i FROM (SELECT e.doc_id, w, p, unnest(range(0, n - p)) AS i FROM e JOIN pairs ON pairs.doc_id = e.doc_id)
  WHERE w[i + 1] = w[i + p + 1]),
stretches AS (
  SELECT doc_id, p, min(i) AS start, count(*) + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM places)
  GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(6, 4 * p)),
runs AS (SELECT doc_id, start, length, min(p) AS period FROM stretches GROUP BY ALL),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS x
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
word AS (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM e),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS x FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT e.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed.x, '')) AS runs_sha256, sha256(coalesce(kept.x, '')) AS collapsed_sha256
FROM e LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def _vector_codes_sql(rounds: int) -> str:
    """Rounds of assigning and averaging, one after the other."""
    steps = [
        """kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v, len(embedding) // 4 AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, w, v[p * w + 1 : p * w + w] AS part FROM kept, range(4) positions(p)),
book0 AS (
  SELECT p, n - 1 AS e, part AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS n FROM parts) WHERE n <= 256)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT vec_id, p, any_value(part) AS part, min({{'d': d, 'e': e}}) AS best
  FROM (SELECT vec_id, p, part, e, list_sum(list_transform(range(1, w + 1), lambda i: (part[i] - c[i]) * (part[i] - c[i])))::BIGINT AS d
        FROM parts JOIN book{k} USING (p))
  GROUP BY vec_id, p)""")
        if k < rounds:
            steps.append(f"""mean{k} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT p, best.e AS e, i, sum(x)::BIGINT AS s, count(*) AS n
        FROM (SELECT p, best, unnest(range(len(part))) AS i, unnest(part) AS x FROM near{k}) GROUP BY ALL)
  GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (p, e))""")
    return f"""
WITH {", ".join(steps)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS x FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT x FROM book) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


SQL["op12_vector_codes"] = _vector_codes_sql(vector_codes.ROUNDS)
