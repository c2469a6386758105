"""One registered query for each operator of this package, over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intervalflow.session import scratch_path

from . import fingerprints, langid, mixing, pii, quality, rules, sentencepieces, tokenfile, variants, warc, whitening
from .capfilter import similar
from .minhash import near_duplicates
from .sampling import split_of


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it (the model writes a space for the character U+2581)."""
    model = sentencepieces.Model.load()
    back = sentencepieces.encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), model=model, decoded_col="decoded")
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), sentencepieces.SPACE, " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


def op2_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(warc.plan_records(_read(spark, sf_dir, "pages")), scratch_path(spark, "archives"))
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
k AS (SELECT html, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.html = k.html AND n >= 1000
"""


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with pseudonymised texts, and where the pseudonyms are."""
    return pii.pseudonymise(_read(spark, sf_dir, "documents").select("doc_id", "text"), spans_col="spans")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.train(docs)
    rows = docs.select("doc_id", (split_of("doc_id") == 2).alias("held_out"), "text")
    return langid.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", (split_of("doc_id") == 2).alias("held_out"), "text")
    scored = quality.quality_scores(rows, _read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(_read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), k=4).withColumnRenamed("id", "doc_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       rules.rejected(rules.BASE).alias("base_failed"), (~rules.rejected(rules.CURRENT)).alias("kept"), "fail_bits")


OP8_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
win AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
        FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT rid, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines
        FROM (SELECT rid, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid, line) GROUP BY rid),
m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        length(regexp_replace(text, '[^A-Za-z\\x{C0}-\\x{10FFFF}]+', '', 'g')) AS n_letters,
        length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper
      FROM w LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
        + 8 * (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)::BIGINT + 16 * (2 * word_chars < 5 * n_words)::BIGINT
        + 32 * (word_chars > 15 * n_words)::BIGINT + 64 * (100 * n_letters < 60 * word_chars)::BIGINT
        + 128 * (2 * n_upper > n_letters)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(_read(spark, sf_dir, "documents"), path)
    return tokenfile.digests(tokenfile.read_tokens(spark, path))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots of every text and of its edited one, their likeness, and where the edit begins."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = fingerprints.with_next(docs, "doc_id", "text", {"body": F.col("text"), "tree": fingerprints.tree("text")})
    rows = rows.withColumn("edited", fingerprints.edited(F.col("body"), F.col("next_body")))
    rows = rows.select("doc_id", F.length("body").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "tree", fingerprints.tree("edited").alias("edited_tree"), "next_tree")
    rows = rows.withColumns({f"{t}_leaves": fingerprints.leaves(t) for t in ("tree", "edited_tree", "next_tree")})

    def like(other: str) -> Column:
        return fingerprints.likeness(F.col("tree.root"), F.col("tree_leaves"), F.col(f"{other}.root"), F.col(f"{other}_leaves"))

    return rows.select("doc_id", "n_chars", "edited_sha256", F.col("tree.root").alias("fingerprint"), F.col("edited_tree.root").alias("edited_fingerprint"),
                       like("edited_tree").alias("near_edited"), like("next_tree").alias("near_next"),
                       fingerprints.first_edit("tree", "edited_tree")["paragraph"].cast("long").alias("edit_paragraph"))


def _tree_sql(text: str, name: str) -> str:
    """DuckDB twin of ``fingerprints.tree``: root, distinct pieces and paragraph digests of each row of a table (doc_id, text)."""
    return f"""
{name}_p AS (SELECT doc_id, list_transform(string_split({text}, chr(10)), lambda l: list_transform(
    regexp_extract_all(l, '{fingerprints.PIECE}'), lambda x: sha256('0' || x))) AS pieces FROM e),
{name}_d AS (SELECT doc_id, pieces, list_transform(pieces, lambda p: sha256('1' || array_to_string(p, ''))) AS paras FROM {name}_p),
{name}_e AS (SELECT *, list_filter(range(1, len(paras) + 1), lambda i: i = len(paras) OR len(pieces[i]) = 0 OR paras[i][1] IN ('0', '1')) AS ends FROM {name}_d),
{name}_s AS (SELECT *, list_transform(range(1, len(ends) + 1), lambda k: sha256('2' || array_to_string(
    paras[(CASE WHEN k = 1 THEN 1 ELSE ends[k - 1] + 1 END):ends[k]], ''))) AS secs FROM {name}_e),
{name} AS (SELECT doc_id, paras, sha256('3' || array_to_string(secs, '')) AS root, list_distinct(flatten(pieces)) AS leaves FROM {name}_s)"""


def _like_sql(a: str, b: str) -> str:
    return (f"CASE WHEN {a}.root = {b}.root THEN 1.0 WHEN len({a}.leaves) + len({b}.leaves) = 0 THEN 0.0 "
            f"ELSE 2.0::DOUBLE * len(list_intersect({a}.leaves, {b}.leaves)) / (len({a}.leaves) + len({b}.leaves)) END::DOUBLE")


OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
      FROM d WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT *, substring(text, 1, n - n // 4) || substring(next_text, 1, n // 4) AS edited FROM o),
{_tree_sql("text", "a")},
{_tree_sql("edited", "b")}
SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, a.root AS fingerprint, b.root AS edited_fingerprint,
       {_like_sql("a", "b")} AS near_edited, {_like_sql("a", "x")} AS near_next,
       CASE WHEN a.root <> b.root THEN list_position(list_transform(range(1, greatest(len(a.paras), len(b.paras)) + 1),
            lambda i: coalesce(a.paras[i], '') = coalesce(b.paras[i], '')), false)::BIGINT END AS edit_paragraph
FROM e JOIN a USING (doc_id) JOIN b USING (doc_id) JOIN a x ON x.doc_id = e.next_id
"""


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whitening.whiten(_read(spark, sf_dir, "embeddings"))
    explained = [] if model is None else model.explained.tolist()
    return rows.select(F.col("id").alias("vec_id"), F.col("deviation").cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc_archives": op2_warc_archives,
    "op3_pii_pseudonyms": op3_pii_pseudonyms,
    "op4_language_id": op4_language_id,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_token_files": op10_token_files,
    "op11_fingerprints": op11_fingerprints,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {"op2_warc_archives": OP2_SQL, "op8_quality_rules": OP8_SQL, "op11_fingerprints": OP11_SQL}
