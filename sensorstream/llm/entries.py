"""The registered queries of this package, over whole tables, and their SQL oracles."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sensorstream.llm import licenses, quality, toxicity, urls
from sensorstream.llm.common import text_of, with_arrow
from sensorstream.llm.exact import DigestIndex, normalised
from sensorstream.llm.negatives import hard_negatives
from sensorstream.llm.packing import pack_along_curve
from sensorstream.llm.periodic import with_runs
from sensorstream.llm.pieces import decode_documents, encode_documents
from sensorstream.llm.repeats import without_repeats
from sensorstream.llm.sampling import fold
from sensorstream.llm.simhash import hex_of, near_duplicates
from sensorstream.llm.tokenfile import documents_of, write_token_files
from sensorstream.llm.tokenizing import public_path
from sensorstream.llm.vectors import near_duplicate_vectors
from sensorstream.session import new_folder

#: Vocabularies by file name, and ids of the one that is written and packed.
WORD_BPE, WORD_BPE_IDS, END_ID = "word_bpe_49k.json", 49408, 1
PIECE_BPE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the licence it names, with the Dice coefficient."""
    found, names = licenses.best_license(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(F.col(names[c]).alias(c) for c in ("license", "dice", "matches")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its pieces, and the text that comes back from them, as checksums."""
    model = public_path(PIECE_BPE)
    encoded = encode_documents(table(spark, sf_dir, "documents"), model)
    decoded = decode_documents(encoded, model)
    return decoded.select("doc_id", "n_tokens", "ids_crc32", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector its links and its component."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page the rule or pattern that fits its url, and the verdict."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged, names = urls.UrlFilter(pages).judge(pages)
    return judged.select(
        "page_id", *(F.col(names[c]).alias(c) for c in ("host", "path", "rule", "verdict", "pattern"))
    )


def op5_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document where its ids lie in the written files, and their checksum, read back."""
    path = new_folder(spark, "token-ids")
    write_token_files(
        table(spark, sf_dir, "documents"), path, public_path(WORD_BPE), vocabulary=WORD_BPE_IDS, end_id=END_ID
    )
    return documents_of(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the row that stays for its text.

    The index is first given the documents of about half of the texts, so that all of them then meet one that
    knows some texts and not others.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = DigestIndex(spark, new_folder(spark, "digest-index"), expected=docs.count())
    index.add(docs.where(F.xxhash64(normalised(text_of("text"))) < 0), carry=[])
    decided, names = index.add(docs, carry=["doc_id"])
    index.close()
    return decided.select(
        "doc_id",
        *(F.col(names[c]).alias(c) for c in ("keep_id", "group_size", "kept")),
        F.lower(F.hex(F.col(names["digest"]))).alias("text_sha256"),
    )


def _scored(scored: DataFrame, held_out, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its toxicity."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"))
    held_out = fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT
    return _scored(toxicity.with_score(docs, model, "score"), held_out, toxicity.THRESHOLD)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(spark, docs, table(spark, sf_dir, "labels"))
    held_out = fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT
    return _scored(quality.with_score(docs, model, "score"), held_out, quality.THRESHOLD)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its fingerprint and the component of its near duplicates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grouped, names = near_duplicates(docs, size=3, radius=2, carry=["doc_id"])
    return grouped.select(
        "doc_id",
        hex_of(F.col(names["fingerprint"])).alias("fingerprint"),
        F.col(names["component"]).alias("component_id"),
    )


def packed(docs: DataFrame, most_ranges: int | None = None) -> DataFrame:
    """Pieces of documents in sequences, with the checksum of their ids."""
    pieces = pack_along_curve(
        docs, public_path(WORD_BPE), vocabulary=WORD_BPE_IDS, end_id=END_ID, most_ranges=most_ranges
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences along the curve."""
    return packed(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per anchor and positive the hardest negatives below it."""
    x = F.col("embedding")
    finite = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").where(finite).select(
        F.col("vec_id").alias("id"),
        moved.alias("label"),
        F.transform(x, lambda c: F.floor(256 * c.cast("double"))).alias("v"),
    )
    return hard_negatives(vectors, F.col("id") % 50 == 0)


def repeating(texts: list[str | None], ids: list[int | None]) -> list[str | None]:
    """Texts of which those that the crc32 of the id picks repeat their words with a period."""
    out = []
    for text, doc_id in zip(texts, ids):
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            words = (text or "").encode().split()
            n, g = len(words), h // 10
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)]).decode()
        out.append(text)
    return out


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its runs of repeated words, the longest one, and the text without repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = with_arrow(
        docs,
        [("words", StringType())],
        lambda b: [pa.array(repeating(b.column(1).to_pylist(), b.column(0).to_pylist()), pa.string())],
    )
    found, names = with_runs(made.select("doc_id", "words"), text="words")
    runs = F.col(names["runs"])
    longest = F.array_max(
        F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"]))
    )
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("*", longest.alias("best"))
    return best.select(
        "doc_id",
        F.size(runs).cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col(names["collapsed"]).cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what is removed as a repeat of 100 bytes, and the checksum of the rest."""
    left, names = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes, spans, kept = (F.col(names[c]) for c in ("n_bytes", "spans", "kept"))
    return left.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length(kept)).cast("bigint").alias("n_removed"),
        F.size(spans).cast("bigint").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_sentencepiece,
        op3_embedding_near_dedup,
        op4_url_filter,
        op5_token_binary,
        op6_exact_dedup,
        op7_toxicity,
        op8_quality,
        op9_simhash,
        op10_packing,
        op11_hard_negatives,
        op12_periodic_runs,
        op13_suffix_dedup,
    )
}


def _pattern_sql() -> str:
    """Whether a pattern rule fits, trying every one: (number, verdict, text)."""
    rows = [
        (0 if rule.verdict == urls.ALLOW else 1, number, rule)
        for number, rule in enumerate(urls.RULES)
        if not rule.site
    ]
    return " ".join(
        f"WHEN regexp_matches(host || rest, '{rule.regex}') THEN '{rule.pattern}'"
        for _, _, rule in sorted(rows, key=lambda r: r[:2])
    )


_SITE = "(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"


def _site_sql() -> str:
    sites = sorted((r for r in urls.RULES if r.site), key=lambda r: -len(r.pattern))
    cases = []
    for rule in sites:
        host, _, path = rule.pattern.partition("/")
        cases.append(f"WHEN {_SITE.format(host=host, path='/' + path)} THEN '{rule.pattern}'")
    return " ".join(cases)


def _verdict_sql(column: str, rules) -> str:
    names = ", ".join(f"'{r.pattern}'" for r in rules if r.verdict == urls.BLOCK)
    return f"CASE WHEN {column} IN ({names}) THEN 'block' ELSE 'allow' END"


ORACLES = {
    "op1_license_scan": licenses.oracle_sql(),
    "op3_embedding_near_dedup": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::double) AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a, vectors b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id <= coalesce(b, vec_id) AS kept
FROM vectors LEFT JOIN counts ON vec_id = counts.a LEFT JOIN least ON vec_id = least.a""",
    "op4_url_filter": f"""
WITH parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '^((?s:.*?))://([^/?#]*)((?s:.*))$', 2), '') AS raw,
    coalesce(regexp_extract(url, '^((?s:.*?))://([^/?#]*)((?s:.*))$', 3), '') AS rest
  FROM pages
), cut AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^?#]*') AS path,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts
), ruled AS (
  SELECT *, CASE {_site_sql()} END AS rule, CASE {_pattern_sql()} END AS fits FROM cut
)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN fits END AS pattern,
  CASE WHEN rule IS NOT NULL THEN {_verdict_sql("rule", urls.SITE_RULES)}
       ELSE {_verdict_sql("coalesce(fits, '')", urls.PATTERN_RULES)} END AS verdict
FROM ruled""",
    "op11_hard_negatives": """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::double)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    cast(list_inner_product(a.v, b.v) AS bigint) AS score
  FROM vectors a, vectors b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
  cast(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS integer) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3""",
    "op6_exact_dedup": r"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM hashed WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked""",
}
