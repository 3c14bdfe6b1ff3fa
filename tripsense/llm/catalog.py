"""The training-data operators as queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsense.llm import chat, decontaminate, fim, html, licences, mixing, quality, reputation, ring, secrets, simhash, spelling, toxicity
from tripsense.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_latent_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    held = decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return held.select(F.col("id").alias("doc_id"), "item_id", "share", "cosine", "start_word")


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_weak_supervision(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def _spans(kinds: list[str] | None = None) -> Column:
    chosen = F.col("spans") if kinds is None else F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op4_secret_automaton(spark: SparkSession, sf: str) -> DataFrame:
    base = [rule.kind for rule in secrets.BASE_RULES]
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in base]
    return secrets.find_secrets(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), *counts, F.sha2(_spans(base), 256).alias("base_sha256"), _spans().alias("spans")
    )


def op5_block_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.taken_words(*mixing.mix(table(spark, sf, "documents")))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_factorization_machine(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    machine = toxicity.train(documents, table(spark, sf, "labels"))
    return toxicity.score(documents, machine).select(
        F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_event_fold(spark: SparkSession, sf: str) -> DataFrame:
    escaped = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(escaped)
    return chat.digests(chat.formatted(chat.messages(chat.streamed_events(rows), within=chat.WITHIN)))


def op8_boosted_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    trees = html.train(html.sample_paragraphs(pages))
    return html.main_text(pages, trees).select(F.col("id").alias("page_id"), "url", "text", "n_chars")


def op9_bounded_ring(spark: SparkSession, sf: str) -> DataFrame:
    plain = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = table(spark, sf, "documents").select(
        "doc_id", ring.text_bytes("text").alias("bytes"), F.crc32(plain.cast("binary")).alias("text_crc32")
    )
    return ring.shard_rows(narrow, size="bytes", tie="text_crc32").select(
        "doc_id", (F.col("bytes") + 1).alias("size"), "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Labels of the document that a page shows, its number standing in the page's path: bad if toxic or of low quality."""
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    known = F.col("toxic").isNotNull() | F.col("quality").isNotNull()
    return labels.select(F.col("doc_id").alias("label_id"), F.when(known, bad.cast("int")).alias("bad"))


def op10_host_reputation(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = reputation.url_verdicts(table(spark, sf, "pages"), page_outcomes(table(spark, sf, "labels")))
    return verdicts.select("page_id", "host", "path", "rule", "verdict")


def op11_bloom_neighbourhoods(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


def op12_boundary_set(spark: SparkSession, sf: str) -> DataFrame:
    made = fim.round_trip(fim.fill_in_middle(table(spark, sf, "documents")))
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_licence_automaton(spark: SparkSession, sf: str) -> DataFrame:
    def joined(names: str | Column) -> Column:
        return F.array_join(names, ",")

    starts = F.transform("base", lambda place: place["start"])
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda place: place["label"])))
    return licences.scan(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"), joined("labels").alias("labels"), "score",
        joined("in_force").alias("in_force"),
    )


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


def llm_queries() -> dict[str, Query]:
    return {
        "op1_latent_retrieval": op1_latent_retrieval,
        "op2_simhash": op2_simhash,
        "op3_weak_supervision": op3_weak_supervision,
        "op4_secret_automaton": op4_secret_automaton,
        "op5_block_mixing": op5_block_mixing,
        "op6_factorization_machine": op6_factorization_machine,
        "op7_event_fold": op7_event_fold,
        "op8_boosted_extraction": op8_boosted_extraction,
        "op9_bounded_ring": op9_bounded_ring,
        "op10_host_reputation": op10_host_reputation,
        "op11_bloom_neighbourhoods": op11_bloom_neighbourhoods,
        "op12_boundary_set": op12_boundary_set,
        "op13_licence_automaton": op13_licence_automaton,
        "pipeline": pipeline,
    }


_HOSTS = """
WITH parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages
), outcome AS (
  SELECT doc_id, max(CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (toxic IS NOT NULL OR quality IS NOT NULL) GROUP BY doc_id
), host AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
    CASE WHEN string_split(host, '.')[-2] || '.' || string_split(host, '.')[-1] IN
      ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'com.au', 'com.br', 'gov.uk', 'org.uk') THEN 2 ELSE 1 END AS labels
  FROM parsed LEFT JOIN outcome ON doc_id = TRY_CAST(nullif(regexp_extract(path, '^/[^/]*/([0-9]{1,18})', 1), '') AS BIGINT)
  GROUP BY host
), named AS (
  SELECT host, n, bad, array_to_string(string_split(host, '.')[-labels:], '.') AS suffix,
    array_to_string(string_split(host, '.')[-(labels + 1):], '.') AS domain FROM host
)"""


def _level(name: str, children: str, keys: str) -> str:
    """Sums of a level and the strength of its prior, as moments of the children's rates give it."""
    return f""", {name}_sums AS (
  SELECT {keys}, sum(n) AS n, sum(bad) AS bad, sum(n * n) AS squares,
    sum(CASE WHEN n > 0 THEN bad * bad / n ELSE 0 END) AS spread, count(*) FILTER (n > 0) AS seen
  FROM {children} GROUP BY {keys}
), {name}_moments AS (
  SELECT *, n - squares / n AS size, bad / n * (1 - bad / n) AS chance,
    (spread - bad * (bad / n) - (seen - 1) * (bad / n * (1 - bad / n))) / nullif(n - squares / n, 0) AS between_
  FROM {name}_sums
), {name} AS (
  SELECT {keys}, n, bad, CASE WHEN n > 0 AND size > 0 AND between_ > 0 THEN least(greatest(chance / between_ - 1, 1), 10000)
    WHEN n > 0 AND size > 0 THEN 10000 ELSE 1 END AS strength FROM {name}_moments
)"""


def _reputation_sql() -> str:
    return (
        _HOSTS + _level("domains", "named", "domain, suffix") + _level("suffixes", "domains", "suffix")
        + _level("everything", "(SELECT 1 AS one, * FROM suffixes)", "one")
        + """, suffix_rates AS (
  SELECT s.suffix, s.strength, (s.bad + e.strength * (e.bad + 1) / (e.n + 2)) / (s.n + e.strength) AS rate
  FROM suffixes s, everything e
), domain_rates AS (
  SELECT d.domain, d.suffix, d.strength, (d.bad + r.strength * r.rate) / (d.n + r.strength) AS rate
  FROM domains d JOIN suffix_rates r USING (suffix)
), posterior AS (
  SELECT host, (h.bad + r.strength * r.rate) / (h.n + r.strength) AS mean, h.n + r.strength AS weight
  FROM named h JOIN domain_rates r USING (domain, suffix)
), ruled AS (
  SELECT page_id, host, path, mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) AS lower_bound,
    (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' AS r1,
    (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' AS r2,
    (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' AS r3,
    (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' AS r4,
    (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' AS r5
  FROM parsed JOIN posterior USING (host)
)
SELECT page_id, host, path,
  CASE WHEN r3 THEN 'www.example.com/en/' WHEN r2 THEN 'example.com/en/' WHEN r4 THEN 'net/es/' WHEN r5 THEN 'net/fr/'
    WHEN r1 THEN 'com/' END AS rule,
  CASE WHEN r3 THEN 'allow' WHEN r2 THEN 'block' WHEN r4 THEN 'block' WHEN r5 THEN 'block' WHEN r1 THEN 'allow'
    WHEN lower_bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""
    )


_BOUNDARIES = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), drawn AS (
  SELECT doc_id, text, tokens, CAST(len(tokens) AS BIGINT) AS n,
    CAST('0x' || digest[1:8] AS BIGINT) % (len(tokens) + 1) AS one, CAST('0x' || digest[9:16] AS BIGINT) % (len(tokens) + 1) AS two,
    CAST('0x' || digest[17:24] AS BIGINT) % 100 AS plain, CAST('0x' || digest[25:32] AS BIGINT) % 100 AS spm
  FROM cut
), parted AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR plain >= 90 THEN 'plain' WHEN spm < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(tokens[1:least(one, two)], '') AS prefix,
    array_to_string(tokens[least(one, two) + 1:greatest(one, two)], '') AS middle,
    array_to_string(tokens[greatest(one, two) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM parted"""


def llm_oracles() -> dict[str, str]:
    return {"op10_host_reputation": _reputation_sql(), "op12_boundary_set": _BOUNDARIES}
