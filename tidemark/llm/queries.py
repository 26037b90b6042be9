"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


MIX_SQL = """
WITH sizes AS (
  SELECT source, CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS DOUBLE) AS bytes FROM documents GROUP BY source
), rates AS (
  SELECT source, pow(bytes, 0.5) * sum(bytes) OVER () / (sum(pow(bytes, 0.5)) OVER () * bytes) AS rate FROM sizes
), pieces AS (
  SELECT source, greatest(ceil(rate / 64.0), 1) AS n, rate / greatest(ceil(rate / 64.0), 1) AS mean FROM rates
), terms AS (
  SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM pieces, range(0, 193) AS t(k)
), curves AS (
  SELECT source, list(upto) AS curve FROM terms GROUP BY source
), draws AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.curve,
    CAST(('0x' || substr(md5('17:' || d.doc_id || ':' || md5(coalesce(d.text, '')) || ':' || p.piece), 1, 13)) AS BIGINT) / pow(2, 52) AS u
  FROM documents d JOIN pieces USING (source) JOIN curves c USING (source), range(1, 1000) AS p(piece)
  WHERE p.piece <= n
), counts AS (
  SELECT doc_id, text, lang, source, n_chars, sum(len(list_filter(curve, lambda x: x <= u))) AS n FROM draws GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS mix_copy,
  CAST(('0x' || substr(md5('order 17:' || doc_id || ':' || md5(coalesce(text, '')) || ':' || copy), 1, 13)) AS BIGINT) / pow(2, 52) AS mix_order
FROM (SELECT *, unnest(range(1, CAST(n AS BIGINT) + 1)) AS copy FROM counts)
"""


@query(MIX_SQL)
def op2_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    from .mixing import poisson_mix

    return poisson_mix(table(spark, folder, "documents"), exponent=0.5, seed=17).drop("mix_rate")


LINES_SQL = """
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
), windows AS (
  SELECT doc_id, unnest(list_transform(range(0, greatest(len(ls) - 2, 0)),
    lambda i: {'pos': i, 'body': ls[i + 1] || chr(10) || ls[i + 2] || chr(10) || ls[i + 3]})) AS w FROM split
), later AS (
  SELECT doc_id, w.pos AS pos FROM windows
  QUALIFY row_number() OVER (PARTITION BY w.body ORDER BY doc_id, w.pos) > 1
), covered AS (
  SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS spot FROM later
), lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS spot FROM split
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY spot) AS text FROM lines l
  WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.doc_id = l.doc_id AND c.spot = l.spot) GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, d.lang, d.source, d.n_chars,
  CAST(coalesce(len(s.ls), 0) AS INTEGER) AS n_lines, CAST(coalesce(r.n, 0) AS INTEGER) AS n_removed
FROM documents d JOIN split s USING (doc_id) LEFT JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)
"""


@query(LINES_SQL)
def op3_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    from .line_windows import remove_repeated_windows

    return remove_repeated_windows(table(spark, folder, "documents"))


@query()
def op5_karmarkar_karp(spark: SparkSession, folder: str) -> DataFrame:
    from .sharding import balanced_shards

    placed = balanced_shards(table(spark, folder, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


WORDS6 = r"regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00]', ' ', 'g'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS6} AS ws FROM documents),
b AS (SELECT item_id, {WORDS6} AS ws FROM benchmark),
passages AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, list_slice(ws, p, p + least(len(ws), 10) - 1) AS body
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p) WHERE len(ws) > 0
), found AS (
  SELECT doc_id, p, n, body FROM (
    SELECT doc_id, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda p: {{'p': p, 'body': list_slice(ws, p, p + n - 1)}}), recursive := true)
    FROM d, (SELECT DISTINCT n FROM passages) WHERE len(ws) >= n
  )
), hits AS (
  SELECT doc_id, p, n, item_id FROM found JOIN passages USING (n, body)
), counts AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS w FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS ids FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query(LEAKS_SQL)
def op6_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    from .winnowing import find_passages

    marked = find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)
    listed = F.array_join("items", ",")
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), "contaminated"
    )


@query()
def op10_pretoken_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import count_tokens

    counted = count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query()
def op1_subword_lattice(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from .lattice import lattice_scores

    rest = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7))
    scored = lattice_scores(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), rest != 2)
    return scored.select("doc_id", (rest == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op7_subword_bags(spark: SparkSession, folder: str) -> DataFrame:
    from .toxicity import toxicity_scores

    rest = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5))
    scored = toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), rest != 0)
    return scored.select("doc_id", (rest == 0).alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic").alias("predicted"))


@query()
def op8_line_labels(spark: SparkSession, folder: str) -> DataFrame:
    from .line_labels import label_lines

    marked = label_lines(table(spark, folder, "documents"), table(spark, folder, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return marked.select("doc_id", *counts, "base_failed", "kept", "content_share")


PROBE = "</s>[INST] ok [/INST]"
CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sizes AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ANSWER\]|\[ROLE\]|\[TEXT\]|\[/TEXT\]|\\')) AS size FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 12 WHEN 'system' THEN 15 ELSE length(role) + 19 END) AS BIGINT) AS formatted_chars
FROM sizes GROUP BY conv_id
"""


@query(CHAT_SQL)
def op9_chat_templates(spark: SparkSession, folder: str) -> DataFrame:
    from .chat import format_conversations, read_back

    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], turns.schema)
    read = read_back(format_conversations(turns.unionByName(probe)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op4_partenum(spark: SparkSession, folder: str) -> DataFrame:
    from .similar import similar_documents

    found = similar_documents(table(spark, folder, "documents"), shingle=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


@query()
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(table(spark, folder, "documents"), drop_every=97)


@query()
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from .alignment import align_tokens

    found = align_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query()
def op12_subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    from .quality import quality_scores

    rest = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))
    scored = quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), rest != 2)
    return scored.select("doc_id", (rest == 2).alias("held_out"), F.col("quality_score").alias("score"), F.col("good").alias("predicted"))
